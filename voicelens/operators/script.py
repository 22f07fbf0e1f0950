"""STR-5 script normalisation with a mapping table (from_word → to_word).

Of all ways to cut a text into mapped phrases and single characters the one with
the fewest units counts; of equal ones the one whose first unit is shorter, and so
on.  Single characters are mapped if the table has them and pass through if not.

* Only characters that occur in the mapping matter.  Their set (an alphabet,
  bounded by the script) cuts a text into *runs*; every distinct run of the corpus
  is worked out once, however many texts share it.
* The phrases of a run are found by a hash join of its substrings with the mapping
  (substrings of those lengths that the mapping has).  The mapping is never
  collected, so a dictionary of any size works; a frequent phrase is one row on its
  side of the join, and Spark splits the other side if it is skewed.
* A text hands on its distinct runs only, never its pieces, and the changed runs of
  a text are put in place one text at a time, so a Python worker holds no more
  than a batch of texts.
* The shortest path over the phrases of one run is a small Arrow function over the
  rows of that run, linear in its length times the number of lengths.
"""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stage import stage
from ..session import written

#: Distinct characters of all phrases: bounded by the script, not by the phrases.
MAX_ALPHABET = 200_000
#: Rows of an Arrow batch that are Python objects at a time.
SLICE = 128


def mapping_rows(mapping: DataFrame) -> DataFrame:
    """One row per non-empty from_word; of repeated words the smallest to_word counts."""
    return mapping.where("from_word != '' AND to_word IS NOT NULL").groupBy("from_word").agg(F.min("to_word").alias("to_word"))


def alphabet_of(rows: DataFrame) -> list[str]:
    """The characters that occur in the mapping."""
    chars = rows.select(F.explode(F.split("from_word", "")).alias("c")).where("c != ''").distinct().limit(MAX_ALPHABET + 1).collect()
    if len(chars) > MAX_ALPHABET:
        raise ValueError(f"the mapping has more than {MAX_ALPHABET} different characters")
    return sorted(r.c for r in chars)


def by_slices(make, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``make`` of each row of the columns; only ``SLICE`` rows at a time are Python objects."""
    parts = [pa.array([make(*row) for row in zip(*(c.slice(at, SLICE).to_pylist() for c in columns), strict=True)], kind) for at in range(0, len(columns[0]), SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def runs_of(text: Column, alphabet: list[str]) -> Column:
    """The distinct runs of a text (null for null)."""
    pattern = "[" + "".join(map(re.escape, alphabet)) + "]+"

    @F.arrow_udf("array<string>")
    def runs(texts: pa.Array) -> pa.Array:
        found = re.compile(pattern).findall
        return by_slices(lambda t: None if t is None else list(dict.fromkeys(found(t))), pa.list_(pa.string()), texts)

    return runs(text)


def replaced_runs(text: Column, changes: Column, alphabet: list[str]) -> Column:
    """The text with its runs changed by ``changes``, an array of (run, converted); null for a null."""
    pattern = "[" + "".join(map(re.escape, alphabet)) + "]+"

    @F.arrow_udf("string")
    def replaced(texts: pa.Array, runs: pa.Array, converted: pa.Array) -> pa.Array:
        sub = re.compile(pattern).sub

        def put(text, run, to):
            if text is None or run is None:
                return text
            table = dict(zip(run, to, strict=True))
            return sub(lambda m: table.get(m[0], m[0]), text)

        return by_slices(put, pa.string(), texts, runs, converted)

    return replaced(text, changes["run"], changes["converted"])


def phrase_hits(runs: DataFrame, rows: DataFrame) -> DataFrame:
    """(run_id, at, n, to_word): the mapped phrases of each run (run_id, run), by a join on their substrings."""
    lengths = [r.n for r in rows.select(F.length("from_word").alias("n")).distinct().collect()]  # at most the longest phrase
    if not lengths:
        return runs.select("run_id", F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit("").alias("to_word")).where("false")
    chars = stage(runs.select("run_id", F.split("run", "").alias("chars")), "chars")
    places = chars.select("run_id", F.size("chars").alias("long"), F.explode(F.flatten(F.transform(
        F.sequence(F.lit(1), F.size("chars")), lambda i: F.array(*[F.struct(i.alias("at"), F.lit(n).alias("n"), F.array_join(F.slice("chars", i, n), "").alias("sub")) for n in lengths])))).alias("p"))
    subs = places.where("p.at + p.n <= long + 1").select("run_id", "p.at", "p.n", F.col("p.sub").alias("from_word"))
    return subs.join(rows, "from_word").select("run_id", "at", "n", "to_word")


def fewest_units(run: str, hits: list[tuple[int, int, str]]) -> str:
    """The run by its cheapest cut; ``hits`` are (place from 1, length, replacement)."""
    n = len(run)
    starts: list[list[tuple[int, str]]] = [[] for _ in range(n)]
    for at, length, word in hits:
        starts[at - 1].append((length, word))
    units, step = [0] * (n + 1), [(1, "")] * n
    for i in range(n - 1, -1, -1):
        best = min([(1 + units[i + length], length, word) for length, word in starts[i]] + ([] if any(x == 1 for x, _ in starts[i]) else [(1 + units[i + 1], 1, run[i])]))
        units[i], step[i] = best[0], best[1:]
    out, i = [], 0
    while i < n:
        out.append(step[i][1])
        i += step[i][0]
    return "".join(out)


def converted_runs(runs: DataFrame, rows: DataFrame) -> DataFrame:
    """(run, converted) for those distinct runs (run_id, run) that change."""
    hits = phrase_hits(runs, rows).groupBy("run_id").agg(F.collect_list(F.struct("at", "n", "to_word")).alias("hits"))  # the hits of one run

    @F.pandas_udf("string")
    def convert(run: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([fewest_units(r, [(h["at"], h["n"], h["to_word"]) for h in hs]) for r, hs in zip(run, found, strict=True)])

    return runs.join(hits, "run_id").select("run", convert("run", "hits").alias("converted")).where("run != converted")


def normalize_script(df: DataFrame, mapping: DataFrame, text_col: str, out_col: str | None = None) -> DataFrame:
    """``df`` with the text of ``text_col`` converted (into ``out_col``, by default in its place).

    Null texts stay null, equal texts are converted once, repeated rows stay; an
    empty mapping changes nothing.  Other columns of any name are carried along.
    """
    out_col = out_col or text_col
    rows = written(mapping_rows(mapping), "script-mapping")
    alphabet = alphabet_of(rows)
    if not alphabet:
        return df.withColumn(out_col, F.col(text_col))
    columns = [c for c in df.columns if c != out_col]
    packed = df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), df[text_col].cast("string").alias("_text"))
    cut = packed.where("_text is not null").select(F.unhex(F.sha2("_text", 256)).alias("_key"), runs_of(F.col("_text"), alphabet).alias("_runs")).where(F.size("_runs") > 0)
    held = stage(cut, "_runs").select("_key", F.explode("_runs").alias("run"))
    runs = held.select("run").distinct().select(F.sha2("run", 256).alias("run_id"), "run")
    changed = written(converted_runs(runs, rows), "script-changes")
    tables = held.join(changed, "run").groupBy("_key").agg(F.collect_set(F.struct("run", "converted")).alias("_changes"))  # the runs of one text
    joined = packed.withColumn("_key", F.unhex(F.sha2("_text", 256))).join(tables, "_key", "left")
    text = replaced_runs(F.col("_text"), F.col("_changes"), alphabet)
    return joined.select(*[F.col(f"_row.`{c}`").alias(c) for c in columns], text.alias(out_col))
