import os

import pytest

ALPHABET = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna".split()
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
#: Null, empty, blank, letterless, short, repeated, long and obfuscated texts.
TEXTS = [
    None, "", " \n\t ", "a", "hello world this is a text of some words and of more words to come again",
    "hello world this is a text of some words and of more words to come again", LONG, LONG + " more", "!!! ???",
    "ünïcödé ß é 東京 ÉCOLE", "You stupid idiot, here we go again my friend", "1d10t", "x " * 100, "a\n b\n\n  c\t\td  e \x0b f",
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Every kind of odd row, null and repeated ids, and columns whose names operators use themselves."""
    rows = [(i, t, ["en", "de", None][i % 3], ["s", None][i % 2], None, 5.0, "z", "y", 1) for i, t in enumerate(TEXTS)]
    rows += [(None, t, None, None, None, None, None, None, None) for t in TEXTS]
    rows += [(3, "a", "en", "s", 1, 1.0, "z", "y", 1)] * 2
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint, toxicity double, _rep string, rep string, _row int"
    return spark.createDataFrame(rows, kinds).repartition(3)


@pytest.fixture(scope="session")
def odd_folder(spark, odd_documents, tmp_path_factory):
    """A folder of odd tables and one of empty tables."""
    labels = [(i, 1, int(i in (10, 11))) for i in range(len(TEXTS))] + [(None, None, None), (3, None, None)]
    bench = [(0, "a"), (1, None), (2, ""), (None, "of some words and of more words to come again"), (3, "this is a text of some words and of more words to come again yes")]
    big = "x" * 2000
    pages = [(0, "http://a\r\nb", None), (1, None, ""), (2, "u", big), (3, "v", big), (None, "u", big), (2, "u", big), (3, "v", big)]
    pages += [(4, "w", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.1\r\n" + "q" * 1500)]
    turns = [(1, 0, "system", "s"), (1, 1, "user", "hi there"), (1, 2, "assistant", "The call"), (1, 3, "user", None), (1, 4, "assistant", None)]
    turns += [(None, None, None, None), (2, 0, "assistant", "The x"), (2, 0, "assistant", "The x")]
    tables = {
        "documents": odd_documents,
        "labels": spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        "benchmark": spark.createDataFrame(bench, "item_id bigint, text string"),
        "pages": spark.createDataFrame(pages, "page_id bigint, url string, html string"),
        "conversations": spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"),
    }
    root = tmp_path_factory.mktemp("odd")
    for name, df in tables.items():
        df.write.parquet(os.path.join(root, "full", f"{name}.parquet"))
        df.limit(0).write.parquet(os.path.join(root, "empty", f"{name}.parquet"))
    return str(root)
