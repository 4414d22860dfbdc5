"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps a bit per failed
rule and the measurements behind them; policies are masks over those bits, so a
new policy, or the question what a rule costs, needs the ledger and no text.

Null or blank text counts as a text without words and fails `few_words`. Rows
are judged one by one, so repeated ids and null ids are just further rows.
Columns of the input other than the id and the text are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.llm.common import words_of

SYMBOLS = "[#*$%&|<>]"
HAS_WORD = "[^\\x20\\x09-\\x0D]"

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
)

# name and test of failure over the measures; the place in the list is the bit
RULES = (
    ("few_words", lambda m: m["n_words"] < 50),
    ("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    ("symbols", lambda m: 20 * m["n_symbols"] > m["word_chars"]),
    ("repeated_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    ("upper_case", lambda m: 10 * m["n_upper"] > 4 * m["word_chars"]),
    ("short_mean_word", lambda m: m["word_chars"] < 2 * m["n_words"]),
    ("long_mean_word", lambda m: m["word_chars"] > 15 * m["n_words"]),
)
BIT = {name: 1 << place for place, (name, _) in enumerate(RULES)}
BASE_MASK = BIT["few_words"] | BIT["repeated_words"]


@dataclass(frozen=True)
class Policy:
    """A version and the rules it enforces."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[name] for name in set(self.rules))


POLICIES = {
    "base": Policy("base", ("few_words", "repeated_words")),
    "v1": Policy("v1", ("few_words", "repeated_words", "symbols", "repeated_lines")),
    "v2": Policy("v2", tuple(BIT)),
}
CURRENT = "v2"


def _has_twin(x: Column, i: Column) -> Column:
    """Whether an entry of the sorted windows has an equal neighbour."""
    windows = F.col("_fl_windows")
    before = (i > 0) & (F.get(windows, i - 1)["h"] == x["h"])
    return before | (F.get(windows, i + 1)["h"] == x["h"])


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with its own columns and one struct `_fl_rules` of measures and failure bits.

    A window of three words is its hash and place. In hash order equal windows
    are neighbours; the places of those that have one, in order, tell how many
    words they cover: three for the first, at most three more for each next.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    words, lines, places = F.col("_fl_words"), F.col("_fl_lines"), F.col("_fl_places")

    def step(df: DataFrame, carry: str, **new: Column) -> DataFrame:
        kept = [F.col(f"_fl_{c}") for c in carry.split()]
        return df.select(*own, *kept, *[c.alias(f"_fl_{name}") for name, c in new.items()])

    window = F.transform(
        words,
        lambda w, i: F.struct(
            F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p")
        ),
    )
    reach = F.transform(
        places,
        lambda p, i: F.when(i == 0, F.lit(3)).otherwise(
            F.least(F.lit(3), p - F.get(places, i - 1))
        ),
    )
    df = step(docs, "", text=F.coalesce(F.col(f"`{text}`"), F.lit("")))
    df = step(
        df,
        "",
        words=words_of(F.col("_fl_text")),
        lines=F.filter(F.split(F.col("_fl_text"), "\n"), lambda line: line.rlike(HAS_WORD)),
        n_symbols=F.size(F.split(F.col("_fl_text"), SYMBOLS)) - 1,
        n_upper=F.size(F.split(F.col("_fl_text"), "\\p{Lu}")) - 1,
    )
    df = step(
        df,
        "n_symbols n_upper",
        n_words=F.size(words),
        word_chars=F.length(F.array_join(words, "")),
        n_lines=F.size(lines),
        n_dup_lines=F.size(lines) - F.size(F.array_distinct(lines)),
        windows=F.sort_array(F.slice(window, 1, F.greatest(F.size(words) - 2, F.lit(0)))),
    )
    counted = "n_symbols n_upper n_words word_chars n_lines n_dup_lines"
    twins = F.filter(F.col("_fl_windows"), _has_twin)
    df = step(df, counted, places=F.sort_array(F.transform(twins, lambda x: x["p"])))
    df = step(df, counted, n_repeat_words=F.aggregate(reach, F.lit(0), lambda acc, x: acc + x))
    flat = {name: F.col(f"_fl_{name}").cast("long") for name in MEASURES}
    failed = [F.when(test(flat), F.lit(BIT[name])).otherwise(F.lit(0)) for name, test in RULES]
    bits = reduce(lambda a, b: a.bitwiseOR(b), failed).cast("long")
    parts = [*[c.alias(name) for name, c in flat.items()], bits.alias("fail_bits")]
    return df.select(*own, F.struct(*parts).alias("_fl_rules"))


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, measures, `fail_bits`."""
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return measured(slim).select("doc_id", "_fl_rules.*")


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with the verdict of one policy version."""
    masked = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    return rows.withColumns(
        {
            "base_failed": F.col("fail_bits").bitwiseAND(F.lit(BASE_MASK)) != 0,
            "kept": masked == 0,
            "policy": F.lit(policy.version),
        }
    )


def keep(docs: DataFrame, policy: Policy, text: str = "text") -> DataFrame:
    """The documents that a policy keeps, with their own columns."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    bits = F.col("_fl_rules.fail_bits").bitwiseAND(F.lit(policy.mask))
    # A plain filter on the measures would be moved to where the text is read, and
    # there split it anew for every word; one on a generated column stays.
    verdict = F.explode_outer(F.when(bits == 0, F.array(F.lit(True)))).alias("_fl_kept")
    return measured(docs, text).select(*own, verdict).where("_fl_kept").select(*own)


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of a policy: documents failing it, and those kept again without it.

    The ledger is first counted by its masked bits, which are at most two to the
    number of rules, so the rest is arithmetic on a few rows.
    """
    combos = (
        rows.select(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits"))
        .groupBy("bits")
        .agg(F.count("*").alias("n"))
    )
    each = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                  for r in dict.fromkeys(policy.rules)])
    )
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    only = F.col("bits") == F.col("r.bit")
    return (
        combos.withColumn("r", each)
        .groupBy(F.col("r.rule").alias("rule"), F.col("r.bit").alias("bit"))
        .agg(
            F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("failed"),
            F.coalesce(F.sum(F.when(only, F.col("n"))), F.lit(0)).alias("kept_without"),
        )
    )
