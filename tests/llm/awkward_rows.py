"""Documents with every awkward row in them."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

PROSE = ["the cat sat on the mat and looked at the dog", "der hund und die katze sind im haus und schlafen",
         "le chat et le chien sont dans la maison avec nous", "el gato y el perro duermen en la casa grande"]
LANGS = ["en", "de", "fr", "es"]


def documents():
    rows = []
    for i in range(80):
        k = i % 4
        rows.append((i, f"{PROSE[k]}. {PROSE[k][: 20 + i % 9]} n{i} {PROSE[k][i % 7:]}", LANGS[k], f"src{i % 3}", None))
    rows += [
        (100, None, None, None, None), (101, "", "en", "s", 0), (102, "   \n\t ", None, None, 6),
        (103, "123 456 !!", "en", None, 10), (104, "x", "en", "s", 1), (105, "word " * 60_000, "en", "s", 300_000),
        (106, "y" * 5_000, None, None, -1), (107, "été \U0001F642 ﬁ ▁ tab\tend", "fr", "s", None),
        (108, "a" + "   " * 30 + "b  ", "en", "s", None), (109, "it's we'll 'tis <|endoftext|> x", "en", "s", None),
        (None, "a row without id that stands alone here", "en", "s", None), (None, None, None, None, None),
        (5, rows[5][1], "de", "src2", None), (5, rows[5][1], "de", "src2", None),
        (110, rows[6][1], "fr", "s", 3), (111, rows[6][1], "fr", "s", 3),
    ]
    return rows
