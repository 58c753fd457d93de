"""Pure DataFrame operators: nothing here reads or writes storage."""
