"""Personal data in texts, found in DataFrame operations only.

Patterns propose spans, checksums confirm them, and words close by adjust the
score of those that no checksum settles. Positions come from the pieces between
matches, so they count code points of the whole text. The patterns are written
so that a run of characters is read once: a match starts at the start of such a run
or where the last match ended, which changes no match and keeps long runs linear.
"""

from pyspark.sql import functions as F

# The base kinds, in order, and what they match.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Kinds that the method adds; fixed values: the forms of key ids and key blocks.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])"
ID_NUMBER = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
KEY_ID = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
KEY_BLOCK = r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s:,.-]*?-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----"
SECRET = r"(?<![A-Za-z0-9])[A-Za-z0-9_/+-]{24,}+(?![A-Za-z0-9_/+-])"

#: Words that make a number or a string more likely to be personal, and those that make it less so.
ID_WORDS = r"(?i)(?:ssn|social|security|identity|passport|licen[cs]e|insurance|tax)"
SECRET_WORDS = r"(?i)(?:token|secret|passw(?:or)?d|api[_ -]?key|apikey|credential|bearer)"
NOT_WORDS = r"(?i)(?:example|invoice|order|version|isbn|sha-?256|md5|commit)"
#: Code points before a span in which context words count.
CONTEXT = 40
#: Spans without a checksum are kept from this score on.
LEAST_SCORE = 0.5


def _let(value, body):
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


SPANS = "array<struct<at:int,stop:int,match:string>>"


def _spans(text, pattern, fits):
    """SPANS of the leftmost matches that do not overlap, those that fit."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("stop"), F.array().cast(SPANS).alias("spans"))

    def step(acc, pair):
        at = acc.stop + F.length(pair.piece)
        return _let(F.struct(at.alias("at"), (at + F.length(pair.match)).alias("stop"), pair.match.alias("match")), lambda span: F.struct(
            span.stop.alias("stop"), F.when(fits(span), F.concat(acc.spans, F.array(span))).otherwise(acc.spans).alias("spans")))

    # The last piece follows the last match.
    pairs = F.zip_with(pieces, found, lambda p, m: F.struct(p.alias("piece"), m.alias("match")))
    return F.aggregate(F.filter(pairs, lambda p: p.match.isNotNull()), start, step, lambda acc: acc.spans)


def _digits(match):
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits):
    """Whether a string of digits passes Luhn's check."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(iban):
    """Whether an IBAN's remainder is 1."""
    plain = F.translate(iban, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    values = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).when(c != "", F.ascii(c) - 55))
    return F.aggregate(F.filter(values, lambda v: v.isNotNull()), F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def _ip_fits(span):
    parts = F.transform(F.split(span.match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))


def _card_fits(span):
    return _let(_digits(span.match), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))


def _phone_fits(span):
    return F.length(_digits(span.match)).between(8, 15)


def _score(text, span, base, words):
    """base, adjusted by what stands before the span."""
    start = F.greatest(span.at - CONTEXT, F.lit(0))
    before = F.substr(text, start + 1, span.at - start)
    return F.lit(base) + F.when(before.rlike(words), 0.5).otherwise(0.0) - F.when(before.rlike(NOT_WORDS), 0.3).otherwise(0.0)


def _found(text, pattern, fits):
    """Spans of a pattern; most texts have none and are read once."""
    return F.when(text.rlike(pattern), _spans(text, pattern, fits)).otherwise(F.array().cast(SPANS))


BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "id_number", "key_block", "key_id", "secret")


def find_personal_data(docs, text_col="text"):
    """The documents with one column of spans (array of at, stop, match) for each kind.

    Kinds are ``email``, ``ip`` (parts of 255 at most), ``card`` (16 to 19 digits passing
    Luhn), ``phone`` (8 to 15 digits), and beyond these ``iban`` (remainder 1 modulo
    97), ``id_number`` and ``secret`` (by context), ``key_id`` and ``key_block`` (by form). Positions are code points, ends exclusive.

    A null text counts as empty, and an empty one has no spans. Texts are searched
    whole. Spans of different kinds may overlap. Rows pass one by one, repeated ones
    alike. Input columns of the kinds' names are replaced.
    """
    docs = docs.drop(*BASE_KINDS, *ADDED_KINDS)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({
        "email": _found(text, EMAIL, lambda s: F.lit(True)),
        "ip": _found(text, IP, _ip_fits),
        "card": _found(text, CARD, _card_fits),
        "phone": _found(text, PHONE, _phone_fits),
        "iban": _found(text, IBAN, lambda s: mod97(s.match)),
        "id_number": _found(text, ID_NUMBER, lambda s: _score(text, s, 0.3, ID_WORDS) >= LEAST_SCORE),
        "key_block": _found(text, KEY_BLOCK, lambda s: F.lit(True)),
        "key_id": _found(text, KEY_ID, lambda s: F.lit(True)),
        "secret": _found(text, SECRET, lambda s: (_score(text, s, 0.2, SECRET_WORDS) >= LEAST_SCORE) & s.match.rlike("[0-9]")),
    })


def _labels(kind):
    return F.transform(F.col(kind), lambda s: F.concat_ws(":", F.lit(kind), s["at"].cast("string"), s["stop"].cast("string")))


def span_text(kinds):
    """kind:start:end of all spans, by kind and start, comma-joined."""
    return F.array_join(F.concat(*[_labels(kind) for kind in kinds]), ",")
