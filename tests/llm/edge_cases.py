"""Small tables of edge cases: nulls in every column, empty, blank, short and
very long texts, ties, repeated rows, copies and near copies."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

LONG = " ".join(f"wort{i % 977} of{i % 13}" for i in range(60_000))
NEAR = [f"alpha{i}" for i in range(120)]

EDGE = [
    (1, "The quick brown fox and the lazy dog by the river", "en", "a", 10), (1, "The quick brown fox and the lazy dog by the river", "en", "a", 10),
    (2, None, "en", "a", None), (3, "", "de", "b", 0), (4, " \t\n\x0b\x0c\r ", None, None, 6), (None, "no id here at all, none", "en", "b", 5),
    (None, None, None, None, None), (5, "ß", "de", None, 1), (6, "1234 5678 ###", "fr", "b", 1), (7, LONG, "de", "c", 1),
    (8, " ".join(NEAR), "en", "a", 1), (9, " ".join([*NEAR[:-1], "other"]), None, "c", 1), (10, " ".join(NEAR).upper(), "en", "b", 1),
    (11, "und die katze\nund die katze\n\nder hund 😀 漢字", "de", "a", 1), (12, "a'b 's 'll don't  x", "fr", "", 1), (13, "x", "fr", "a", 1),
    (14, "le chat et la souris dans la maison", "fr", "c", 1), (15, "x", None, "c", 1), (16, "idiot " * 3 + "THE end", "en", "b", 1),
]
LABELS = [(1, 1, 0), (8, 0, 1), (9, None, None), (None, 1, 1), (16, 1, 1), (99, 1, 1), (11, 1, 0), (11, 0, 0), (14, 1, 0), (13, 0, 0)]
BENCHMARK = [(1, " ".join(NEAR[20:35])), (2, "the QUICK brown"), (2, "the quick brown"), (3, None), (4, ""), (None, "the lazy dog"), (5, "zzz yyy"), (6, "x")]
PAGE = ("<html><head><title>t t t</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><article><h1>Head &amp; line</h1>"
        "<p>One <b>two</b>\n three.<p>Four<script>var x='<p>'</script> five six seven</p><div class='comments'>no no no</div></article>"
        "<footer>foot foot</footer></body></html>")
PAGES = [(1, "http://a/b c", PAGE), (1, "http://a/b c", PAGE), (2, None, PAGE), (3, "u\r\nX: y", None), (None, "v", PAGE), (4, "", ""), (5, "w", "no tags é"),
         (6, "w", "y" * 1500), (7, "w", "y" * 1500), (None, None, "y" * 1500), (8, "z", "<p>" * 3000 + "word")]

#: Nulls in every column, ties and repeats of a turn, empty and long
#: conversations, strange roles, one that loses all its rows (100: turn 6).
CONVERSATIONS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hello!"), (1, 2, "assistant", "Hello!"), (1, 2, "user", "And"), (1, 9, "user", "no end"),
    (2, None, "user", "first."), (2, None, None, None), (2, 3, "", "empty role."), (2, 4, "tool", "other role."), (2, 5, "User", "case."), (2, 6, "assistant", ""),
    (None, 1, "user", "no conversation."), (None, None, "assistant", "neither."), (None, 1, "user", "no conversation."), (3, -5, "assistant", "\n\u00a0"),
    (3, 7, "assistant", "Ok.\x0b\r\n "), (4, 1, "user", "same."), (4, 2, "user", "same."), (4, 3, "assistant", "same."), (4, 4, "assistant", "x" * 50_000 + "."),
    *((5, t, ("user", "assistant", "system", "assistant")[t * t % 4], f"turn {t % 11}" + ".?! "[t % 4]) for t in range(400)),
    *((c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(100, 140) for t in range(c % 4)),
    *((c, 0, "user", "alone.") for c in range(200, 260)),
]
