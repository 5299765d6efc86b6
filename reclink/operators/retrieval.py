"""Values with words in common, weighted by how rare the words are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclink.operators.blocking import tokens
from reclink.session import cut

# Rounding of the last digits must not lose a pair that lies on the threshold.
SLACK = 1e-9
LEAST_COSINE = 0.6


def word_set(field: str) -> Column:
    """Distinct words of a value in order, as one text; null for a value without words."""
    return F.when(F.trim(F.col(field)) != "", F.array_join(F.array_sort(tokens(F.col(field))), " "))


def token_vectors(df: DataFrame, field: str) -> DataFrame:
    """(words, vector) for each distinct word set of a field, the rarest word first.

    A word weighs ln(1 + sets / sets with it), and weights are scaled to length 1. `rest` is the length of what follows a
    word. Records of one word set are one row, so a frequent value counts once.
    """
    sets = cut(df.select(word_set(field).alias("words")).where("words is not null").distinct(), "word_sets")
    held = sets.select("words", F.explode(F.split("words", " ")).alias("token"))
    rarity = held.groupBy("token").agg(F.count("*").alias("df"))
    raw = F.log(1 + F.lit(float(sets.count())) / F.col("df"))
    gathered = (
        held.join(rarity, "token")
        .groupBy("words")
        .agg(
            F.array_sort(F.collect_list(F.struct("df", "token", raw.alias("raw")))).alias("found"),
            F.sqrt(F.sum(raw * raw)).alias("length"),
        )
    )
    scaled = gathered.select(
        "words", F.transform("found", lambda w: F.struct(w["token"].alias("token"), (w["raw"] / F.col("length")).alias("weight"))).alias("found")
    )
    after = lambda i: F.sqrt(F.aggregate(F.slice("found", i + 2, F.size("found")), F.lit(0.0), lambda s, w: s + w["weight"] * w["weight"]))
    ranked = F.transform("found", lambda w, i: F.struct(w["token"].alias("token"), w["weight"].alias("weight"), after(i).alias("rest")))
    return scaled.select("words", ranked.alias("vector"))


def token_weights(df: DataFrame, field: str) -> DataFrame:
    """(words, token, weight): the vectors as rows."""
    return token_vectors(df, field).select("words", F.inline("vector")).select("words", "token", "weight")


def _keys(least: float) -> Column:
    """What a pair above the threshold meets under: its first two common words, or its only one.

    With one common word the product of two weights reaches the threshold, so each weight does. With two or more, the
    first word and all from the second on reach it together. Keys that cannot are left out.
    """
    bound = least - SLACK
    reach = lambda first, w: first["weight"] * first["weight"] + w["weight"] * w["weight"] + w["rest"] * w["rest"]
    alone = F.transform(F.filter("vector", lambda w: w["weight"] >= bound), lambda w: w["token"])
    paired = F.flatten(
        F.transform(
            "vector",
            lambda first, i: F.transform(
                F.filter(F.slice("vector", i + 2, F.size("vector")), lambda w: reach(first, w) >= bound * bound),
                lambda w: F.concat(first["token"], F.lit(" "), w["token"]),
            ),
        )
    )
    return F.concat(alone, paired)


def cosine_pairs(df: DataFrame, field: str, least: float = LEAST_COSINE) -> DataFrame:
    """(left_words, right_words, cosine): pairs of distinct word sets with a cosine of at least `least`, each once.

    Sets meet under their first two common words in order of rarity, so a word that very many sets hold makes no group
    of its own. No pair above the threshold is lost (see _keys). A pair is made under its own key only, so nothing is made
    distinct afterwards; vectors go with the keys, as names have few words. Keys grow with the square of the words of a value.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine lies above 0 and up to 1")
    vectors = cut(token_vectors(df, field), "token_vectors")
    keyed = vectors.select(F.explode(_keys(least)).alias("_key"), "words", "vector")
    left = keyed.select("_key", F.col("words").alias("left_words"), F.col("vector").alias("_left"))
    right = keyed.select("_key", F.col("words").alias("right_words"), F.col("vector").alias("_right"))
    common = F.slice(F.array_intersect(F.col("_left.token"), F.col("_right.token")), 1, 2)
    met = left.join(right, "_key").where((F.col("left_words") < F.col("right_words")) & (F.array_join(common, " ") == F.col("_key")))
    weights = F.map_from_arrays(F.col("_right.token"), F.col("_right.weight"))
    dot = F.aggregate("_left", F.lit(0.0), lambda s, w: s + w["weight"] * F.coalesce(F.try_element_at(weights, w["token"]), F.lit(0.0)))
    # Unpacked from a struct, so that the filter does not evaluate the product a second time.
    scored = met.select("left_words", "right_words", F.inline(F.array(F.struct(dot.alias("cosine")))))
    return scored.where(F.col("cosine") >= least)


def cosine_blocks(df: DataFrame, field: str, least: float = LEAST_COSINE, name: str = "cosine", id_col: str = "id") -> DataFrame:
    """(block_key, id) for candidate_pairs: a block for each word set, and one for each pair of near sets with the records of both."""
    records = df.select(F.col(id_col).alias("id"), word_set(field).alias("words")).where("words is not null")
    key = F.concat_ws("|", "left_words", "right_words")
    sides = cosine_pairs(df, field, least).select(key.alias("_key"), F.explode(F.array("left_words", "right_words")).alias("words"))
    near = sides.join(records, "words").select("_key", "id")
    own = records.select(F.col("words").alias("_key"), "id")
    return near.unionByName(own).select(F.concat(F.lit(name + ":"), "_key").alias("block_key"), "id")
