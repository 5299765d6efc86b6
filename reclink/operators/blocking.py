"""Block keys: records that share one are compared."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclink.functions.text import text_key

WORD = r"\s+"


@dataclass(frozen=True)
class Part:
    """One ingredient of a block key: a field and how it is read."""

    field: str
    kind: str = "whole"  # whole, prefix, tokens, soundex, tail, rare
    size: int = 0


@dataclass(frozen=True)
class Rule:
    """A block key made of one or more parts; a record lacking a part gets no key from the rule."""

    name: str
    parts: tuple[Part, ...]


# Every rule joins at least two fields, so that a frequent name, place or phone alone makes no block.
EMPLOYER_RULES = (
    Rule("phone", (Part("phone"), Part("name", "prefix", 1))),
    Rule("words", (Part("name", "tokens"), Part("state"))),
    Rule("start", (Part("name", "prefix", 6), Part("city"), Part("state"))),
    Rule("trade", (Part("trade_name_dba", "tokens"), Part("name", "prefix", 3), Part("state"))),
)


def tokens(value: Column) -> Column:
    return F.array_distinct(F.split(F.lower(F.trim(value)), WORD))


def part_key(part: Part) -> Column:
    """Key text of a part; null when the field gives none."""
    text = F.lower(F.trim(F.col(part.field)))
    value = {
        "whole": lambda: text,
        "prefix": lambda: F.substring(text, 1, part.size),
        "tokens": lambda: F.array_join(F.array_sort(tokens(F.col(part.field))), " "),
        "soundex": lambda: F.soundex(text),
        "tail": lambda: F.right(text, F.lit(part.size)),
    }[part.kind]()
    return F.when(text != "", value)


def field_values(df: DataFrame, fields: list[str]) -> DataFrame:
    """Distinct values of each field, from one scan."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    return df.select(F.inline(cells)).where(F.col("value").isNotNull()).distinct()


def token_index(df: DataFrame, field: str, max_df: int) -> DataFrame:
    """Rare words of a field: those in at most `max_df` of its distinct values."""
    values = df.select(F.lower(F.trim(F.col(field))).alias("value")).where("value != ''").distinct()
    words = values.select(F.explode(F.array_distinct(F.split("value", WORD))).alias("token"))
    return words.groupBy("token").agg(F.count("*").alias("df")).where(F.col("df") <= max_df)


def _joined(rule: Rule, keys: list[Column]) -> Column:
    complete = F.lit(True)
    for key in keys:
        complete = complete & key.isNotNull()
    return F.when(complete, F.concat(F.lit(rule.name + ":"), F.concat_ws("|", *keys)))


def plain_keys(rules) -> Column:
    """Keys of a record under each rule without rare words; null where a part is missing."""
    return F.array(*[_joined(r, [part_key(p) for p in r.parts]) for r in rules])


def shares_a_block(rules, same: list[str]) -> bool:
    """Whether records that agree on the fields, none of them empty, always meet in a block of some rule."""
    return any(all(p.field in same and p.kind != "rare" for p in rule.parts) for rule in rules)


def _rare_keys(df: DataFrame, id_col: str, rule: Rule) -> DataFrame:
    """Keys of a rule whose first part is a rare word; the other parts are plain."""
    rare, rest = rule.parts[0], rule.parts[1:]
    words = df.select(
        F.col(id_col).alias("id"),
        *[part_key(p).alias(f"_{i}") for i, p in enumerate(rest)],
        F.explode(tokens(F.col(rare.field))).alias("token"),
    )
    kept = words.join(token_index(df, rare.field, rare.size).select("token"), "token", "left_semi")
    names = ["token"] + [f"_{i}" for i in range(len(rest))]
    return kept.select(_joined(rule, [F.col(n) for n in names]).alias("block_key"), "id")


def block_keys(df: DataFrame, rules=EMPLOYER_RULES, id_col: str = "id") -> DataFrame:
    """(block_key, id), once per record and key. All plain rules share one scan."""
    plain = [r for r in rules if r.parts[0].kind != "rare"]
    rare = [r for r in rules if r.parts[0].kind == "rare"]
    out = None
    if plain:
        out = df.select(F.col(id_col).alias("id"), F.explode(plain_keys(plain)).alias("block_key")).select("block_key", "id")
    for rule in rare:
        found = _rare_keys(df, id_col, rule)
        out = found if out is None else out.unionByName(found)
    return out.where(F.col("block_key").isNotNull()).distinct()


def block_sizes(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("block_key").agg(F.count("*").alias("n_records"))


def block_stats(blocks: DataFrame, max_block: int) -> DataFrame:
    """Size, pair count, and whether the block is too large to pair record by record."""
    n = F.col("n_records")
    return block_sizes(blocks).select(
        "block_key",
        "n_records",
        F.floor(n * (n - 1) / 2).alias("n_pairs"),
        (n > max_block).alias("oversized"),
    )


def cap_blocks(blocks: DataFrame, max_block: int) -> DataFrame:
    """Mark the rows of blocks above the cap. They are paired in parts instead of being dropped."""
    large = block_sizes(blocks).where(F.col("n_records") > max_block).select("block_key", F.lit(True).alias("_large"))
    return blocks.join(large, "block_key", "left").select(
        "block_key", "id", F.coalesce("_large", F.lit(False)).alias("oversized")
    )
