import itertools
import math
import random

import pytest

from reclink.operators import pairs as P
from reclink.operators import retrieval as R
from reclink.schemas import EMPLOYER
from tests.test_linkage import employer


def plain_pairs(values, least):
    """Cosines of all pairs of word sets, cell by cell."""
    sets = sorted({" ".join(sorted(set(v.lower().split()))) for v in values if v and v.split()})
    held = {s: s.split() for s in sets}
    df = {w: sum(w in t for t in held.values()) for t in held.values() for w in t}
    raw = {w: math.log(1 + len(sets) / n) for w, n in df.items()}
    length = {s: math.sqrt(sum(raw[w] ** 2 for w in t)) for s, t in held.items()}
    out = {}
    for a, b in itertools.combinations(sets, 2):
        cosine = sum(raw[w] ** 2 for w in set(held[a]) & set(held[b])) / (length[a] * length[b])
        if cosine >= least:
            out[a, b] = round(cosine, 9)
    return out


@pytest.mark.parametrize("least", [0.2, 0.6, 0.95])
def test_no_pair_above_the_threshold_is_lost(spark, least):
    draw = random.Random(int(least * 100))
    # A few very frequent words and a tail of rare ones.
    words = ["inc", "llc", "farm"] * 12 + [f"w{i}" for i in range(40)]
    values = [" ".join(draw.choices(words, k=draw.randint(1, 5))) for _ in range(150)] + [None, "", "  ", "Inc", "inc  LLC", "llc inc"]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, name string")
    got = [((r.left_words, r.right_words), round(r.cosine, 9)) for r in R.cosine_pairs(df, "name", least).collect()]
    assert len(got) == len(set(p for p, _ in got))
    assert dict(got) == plain_pairs(values, least)


def test_empty_tables_and_thresholds(spark):
    df = spark.createDataFrame([], "id string, name string")
    assert R.cosine_pairs(df, "name").count() == 0
    assert R.cosine_blocks(df, "name").count() == 0
    with pytest.raises(ValueError):
        R.cosine_pairs(df, "name", 0)


def test_records_of_near_word_sets_share_a_block(spark):
    names = ["blue ridge orchard", "orchard blue ridge", "blue ridge orchards inc", "green acres", "green acres inc", None, ""]
    # More companies, so that inc is a frequent word.
    names += [f"company{i} inc" for i in range(30)]
    df = spark.createDataFrame([employer(f"{i:02}", n) for i, n in enumerate(names)], EMPLOYER)
    rows = R.cosine_blocks(df, "name", 0.6).collect()
    blocks = {}
    for row in rows:
        blocks.setdefault(row.block_key, set()).add(row.id)
    assert len(rows) == sum(map(len, blocks.values()))
    assert {"00", "01"} in blocks.values()
    assert blocks["cosine:acres green|acres green inc"] == {"03", "04"}
    assert not any({"05", "06"} & ids for ids in blocks.values())
    # Of the companies, whose only common word is frequent, no two meet.
    assert all(len(ids) == 1 for key, ids in blocks.items() if "company" in key)
    found = {(r.left_id, r.right_id) for r in P.candidate_pairs(R.cosine_blocks(df, "name"), df).collect()}
    assert ("03", "04") in found
