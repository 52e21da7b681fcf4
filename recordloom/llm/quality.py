"""Quality rules as a ledger: every rule is evaluated once per document, its failure stored as one bit beside the measurements; policies are
masks over those bits, so that another policy, or an ablation, never reads a text again.

Defined cases: a null text has no words, so all measurements are 0 and the rule on few words fails; an empty table gives an empty ledger; equal
rows give equal ledger rows; columns of the input that carry the name of a ledger column stay out of the ledger (only id and text are read) and pass through keep_good().
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: name -> SQL over the measurements that is true where the rule fails. The order fixes the bits; new rules go to the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines",
    "shouting": "n_words >= 20 and 100 * n_upper > 80 * n_letters",
    "long_words": "n_words > 0 and word_chars > 40 * n_words",
}
SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_letters long, n_upper long"
MEASURES = tuple(x.split()[0] for x in SCHEMA.split(", ")[1:])
WINDOW = 8


@dataclass(frozen=True)
class Policy:
    """A version of the decision: a document is rejected if any of these rules failed."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
PRODUCTION = Policy("2", tuple(RULES))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of so many words which the text holds at least twice, the first time included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        code = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
        mixed = np.zeros(n, np.uint64)
        for i in range(window):
            mixed = mixed * np.uint64(0xD6E8FEB86659FD93) + code[i : i + n]
    order = np.sort(mixed)
    twice = order[1:][order[1:] == order[:-1]]
    if not twice.size:
        return 0
    first: dict[tuple, int] = {}
    marked = np.zeros(len(words) + 1, np.int64)
    found = set()
    for i in np.flatnonzero(np.isin(mixed, twice)).tolist():  # equal codes are held against the words themselves
        j = first.setdefault(tuple(words[i : i + window]), i)
        if j != i:
            found.update((i, j))
    for i in found:
        marked[i] += 1
        marked[min(i + window, len(words))] -= 1
    return int((np.cumsum(marked)[:-1] > 0).sum())


def code_points(b: bytes) -> int:
    return len(b) - int(((np.frombuffer(b, np.uint8) & 0xC0) == 0x80).sum())


def measurements(text: bytes | None) -> tuple[int, ...]:
    text = text or b""
    words = text.split()
    bare = text.translate(None, b" \t\n\x0b\x0c\r")
    letters = len(bare) - len(bare.translate(None, UPPER + LOWER))
    upper = len(bare) - len(bare.translate(None, UPPER))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), code_points(bare), len(bare) - len(bare.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), len(lines), letters, upper


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for batch in batches:
        rows = [measurements(x.as_py()) for x in batch.column(1).cast(pa.binary())]
        columns = list(zip(*rows, strict=True)) or [()] * (len(names) - 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names)


def _bits(measured: dict[str, str]) -> Column:
    """fail_bits from measurements: name -> SQL of its value."""
    def rule(text: str) -> str:
        return re.sub(r"\b(" + "|".join(measured) + r")\b", lambda m: measured[m[1]], text)

    return F.expr(" | ".join(f"cast(if({rule(r)}, {1 << i}, 0) as long)" for i, r in enumerate(RULES.values())))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its measurements, and fail_bits with bit i set where rule i of RULES fails. Store it: policies and ablations read it, not the texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_measured, SCHEMA)
    return rows.withColumn("fail_bits", _bits({n: n for n in MEASURES}))


def _failed(mask: int) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))


def apply_policy(rows: DataFrame, policy: Policy, name: str = "kept") -> DataFrame:
    return rows.withColumn(name, _failed(policy.mask) == 0)


def ablations(rows: DataFrame, policies: list[Policy]) -> DataFrame:
    """Per policy and rule: documents that fail the rule, that the policy rejects, that only this rule rejects, and what the policy would reject
    without it. The documents are first counted by their bits, of which there are at most 2**len(RULES)."""
    by_bits = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    spark = rows.sparkSession
    table = spark.createDataFrame([(p.version, r, p.mask, 1 << i) for p in policies for i, r in enumerate(RULES) if r in p.rules], "version string, rule string, mask long, bit long")
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    return (
        by_bits.join(F.broadcast(table), F.lit(True))  # a few policies times a few rules, beside at most 2**len(RULES) rows
        .groupBy("version", "rule")
        .agg(
            F.sum(F.when(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_fail"),
            F.sum(F.when(hit != 0, F.col("n")).otherwise(0)).alias("n_rejected"),
            F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
            F.sum(F.when(hit.bitwiseAND(F.bitwise_not("bit")) != 0, F.col("n")).otherwise(0)).alias("n_without"),
            F.bit_or(F.when(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0, F.col("fail_bits")).otherwise(F.lit(0))).alias("seen_with"),
        )
    )


def with_only_rule(rows: DataFrame, policy: Policy) -> DataFrame:
    """rows of a ledger with only_rule, the rule that alone rejects the document (null if none or several do), and n_only, the documents that the policy would take back
    without that rule, from ablations(). The joined table has a row for each rule."""
    found = ablations(rows, [policy]).select(F.col("rule").alias("only_rule"), "n_only")
    only = F.coalesce(*[F.when(_failed(policy.mask) == 1 << i, r) for i, r in enumerate(RULES)])
    return rows.withColumn("only_rule", only).join(F.broadcast(found), "only_rule", "left")


def keep_good(docs: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """The documents that the policy keeps, with all their columns. The ledger's bits are carried beside the row, so ids need not be unique and texts don't move."""
    names = docs.columns
    carried = "measured"
    while carried in {n.lower() for n in names}:
        carried += "_"

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measurements(x.as_py()) for x in batch.column(names.index("text")).cast(pa.binary())]
            values = pa.array(rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, values], [*names, carried])

    out = docs.mapInArrow(measured, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", {carried} array<bigint>")
    rows = out.select(F.struct(*[f"`{c}`" for c in names]).alias("row"), _bits({n: f"{carried}[{i}]" for i, n in enumerate(MEASURES)}).alias("fail_bits"))
    return apply_policy(rows, policy).where("kept").select("row.*")
