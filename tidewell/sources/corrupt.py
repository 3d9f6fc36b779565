"""The column of records that do not parse."""

#: A record that does not parse keeps its text in this column, and in the landed object.
CORRUPT = "_corrupt_record"
