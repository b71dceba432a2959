import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "ids string, decoded string, row string, node string, n int, first int, score string, lang_pred string"
)


def make_rows():
    """Documents with nulls, empty and long texts, copies, near copies, repeated rows and passages of benchmark items."""
    r = random.Random(7)
    vocab = ["".join(r.choice("abdeilnorst") for _ in range(r.randint(2, 7))) for _ in range(900)]
    line = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    passage = "\n".join(line(14) for _ in range(6))
    texts = {i: "\n".join(line(r.randint(3, 25)) for _ in range(r.randint(1, 9))) for i in range(60)}
    base = line(240)
    for i in range(60, 90):  # a family of near copies
        words = base.split(" ")
        for _ in range(r.randint(0, 5)):
            words[r.randrange(len(words))] = r.choice(vocab)
        texts[i] = " ".join(words)
    for i in range(90, 100):
        texts[i] = texts[3]
    for i in range(100, 112):
        texts[i] = f"{texts[i - 100]}\n{passage}\n{line(12)}"
    texts[112] = None
    texts[113] = ""
    texts[114] = " \n\t "
    texts[115] = "Word"
    texts[116] = "word  WORD"
    texts[117] = "\n".join([line(9)] * 12)
    texts[118] = line(9000)
    texts[119] = "12 345 !! ##"
    texts[120] = f"{line(30)} {' '.join(texts[5].split()[:12])} {line(30)}"
    texts[121] = "Résumé naïve ÉCOLE 日本語 " + "é́" * 50
    texts[122] = "x" * 1000
    texts[123] = texts[118][:20000] + " end"
    langs = ["en", "fr", "de", None]
    rows = [(i, t, langs[i % 4], "s", len(t or ""), "a", "b", "c", "d", 1, 2, "e", "f") for i, t in texts.items()]
    rows += [rows[3], rows[112], rows[118]]  # repeated rows
    items = [(f"i{k}", " ".join(texts[k].split()[:13])) for k in (5, 7)] + [("short", "Word"), ("none", None), (None, "a b"), ("empty", "")]
    return rows, items


@pytest.fixture(scope="session")
def rows():
    return make_rows()[0]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def items():
    return make_rows()[1]


@pytest.fixture(scope="session")
def benchmark(spark, items):
    return spark.createDataFrame([(*i, 1) for i in items], "item_id string, text string, doc_id int")
