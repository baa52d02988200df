"""Small fixtures shared by the tests of the pipeline operators."""

import zlib

#: Texts every row-wise operator must stand.
ODD_TEXTS = [None, "", " ", "  a  b ", "x\n\n y\t", "no end", "é🙂日本語", "z" * 5000, "\x1c \x1d", "¼½ Ⅷ १२"]


def documents(spark, texts, **more):
    """doc_id, text and columns of other names and clashing ones."""
    rows = [(i, t, None, f"src{i % 3}", None if t is None else len(t), 1.5, "x") for i, t in enumerate(texts)]
    names = "doc_id long, text string, lang string, source string, n_chars long, score double, llm_result string"
    return spark.createDataFrame(rows, names)


def crc(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts
