"""Rows with the awkward cases: nulls, empty and long texts, ties, repeated rows."""

TINY = "/root/testdata/sf0.001"
AWKWARD = [
    (1, "one two three"),
    (2, None),
    (3, ""),
    (None, "a text without a name"),
    (4, "same words here"),
    (4, "same words here"),
    (5, "Mixed CASE, marks!! and ’quotes’ … it's  two  spaces\tand\nlines\r\n"),
    (6, "naïve café Ünïcode ǅ Σας ﬁ ½ 日本語 한국어  nbsp　wide \x1c\x85 é"),
    (7, "<|endoftext|> inside <|startoftext|>x <|ENDOFTEXT|> <s></s><unk>"),
    (8, "x" * 9000 + "y" * 5000),
    (9, " " * 7000),
    (10, "ab" * 6000 + " tail"),
    (11, "🙂🙂 � \x00 zero"),
    (12, "12345 6,789.01 $$$ ### %%% don't we'll I'm"),
]
