"""Small tables for the training-data operators."""

import random

import pytest

WORDS = ("river stone light garden window morning quiet copper letter marble engine harbor silver meadow lantern "
         "orchard pocket thunder velvet winter bridge candle desert forest island jacket kettle ladder magnet needle "
         "The of and to in a that is was for on with as by at from it an be this").split()

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "_row string, _size long, shard string, score string, kept string, part string, h string")


def prose(rng, n):
    out = []
    for i in range(n):
        w = rng.choice(WORDS) + (rng.choice("xyz") + rng.choice(WORDS) if rng.random() < 0.5 else "")
        out.append(w + (".\n" if rng.random() < 0.08 else " "))
    return "".join(out).strip()


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, short and very long texts, ties, copies,
    repeated rows, columns whose names clash with internal ones."""
    rng = random.Random(3)
    texts = [prose(rng, rng.choice([3, 40, 120, 300])) for _ in range(60)]
    texts += [None, "", "   \n\t ", "one", "two words", "é ü 漢字 ñandú", "a\x00b c\x00d e", "x" * 5000]
    texts.append(prose(rng, 30_000))
    texts += [texts[0]] * 12 + [texts[1].replace(" ", "  ")] + [texts[2] + " changed", texts[2][:-20] + " other end here"]
    texts += ["same line again here now\n" * 40, "go go go go go go go go " * 20]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s1", "s2", "s10", None]),
             None if t is None else len(t), "r", 1, "s", "x", "k", "p", "h") for i, t in enumerate(texts)]
    rows.append(rows[5])  # a repeated row
    rows.append((None, texts[7], None, None, None, None, None, None, None, None, None, None))  # nothing but a text
    rows.append((None,) * 12)
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
