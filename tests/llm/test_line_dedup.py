from collections import defaultdict

from pyspark.sql import functions as F

from barworks.llm.line_dedup import LineRuns, dedup_lines, document_keys

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows, low=40, least=5):
    order = lambda d: -(1 << 63) if d is None else d
    held = defaultdict(list)
    for doc, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= low:
                held[k].append(order(doc))
    drop = {k: max(v) for k, v in held.items() if len(v) >= least}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if drop.get(key(x), order(doc)) == order(doc)]
        out.append((order(doc), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def result(df):
    return sorted((-(1 << 63) if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect())


def rows_with_shared_lines():
    a, b, c = "Shared line that is long enough to count, A" + "x" * 5, "é" * 40, "é" * 39
    rows = [(k, f"own line {k} which nobody else holds at all, really\n{a}\n {a.upper()} \t") for k in range(7)]
    rows += [(20 + k, f"{b}\n{c}") for k in range(5)] + [(40 + k, f"{'four documents only hold this line, which stays':s}\r") for k in range(4)]
    return rows + [(6, a), (None, a), (None, b + "\n" + a), (100, None), (101, ""), (102, "\n\n")]


def test_against_brute_force(docs):
    rows = rows_with_shared_lines()
    assert result(dedup_lines(docs(rows))) == brute(rows)
    assert result(dedup_lines(docs(rows), batches=1)) == brute(rows)
    assert result(dedup_lines(docs(rows), batches=7, sieve_bits=8)) == brute(rows)


def test_odd_rows_and_columns(docs, odd_rows):
    df = docs(odd_rows).withColumn("n_lines", F.lit("x")).withColumn("key", F.lit(1)).withColumn("id", F.lit(2))
    out = dedup_lines(df)
    assert result(out) == brute(odd_rows)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "id", "n_lines", "n_dropped"]
    assert dedup_lines(docs([])).count() == 0


def test_first_batch_that_holds_a_line_keeps_it(spark, docs):
    line = "this line is long enough for the runs to be counted"
    runs = LineRuns(spark, fanout=2, buckets=4)
    for batch in ([(9, line)], [(3, line), (2, line + "!")], [(1, line)]):
        runs.add(document_keys(docs(batch), "doc_id", "text", 40))
    assert [len(level) for level in runs.levels] == [1, 1]
    assert sorted((r.docs, r.keeper) for r in runs.merged().collect()) == [(1, 2), (3, 9)]
    runs.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]
