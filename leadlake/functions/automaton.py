"""Rule tagging with packs of very many needles: one pass over each text, whatever the number of rules."""

from __future__ import annotations

import pickle
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.rules import TagRules

#: Characters of needles in one automaton, which a broadcast carries to each worker; a larger pack makes several.
MOST_CHARS = 8 << 20


def automata(pack: TagRules) -> list[bytes]:
    """The pack's needles in order, cut into automata of bounded size; each needle carries the numbers of its rules."""
    out, current, chars = [], None, 0

    def close() -> None:
        current.make_automaton()
        out.append(pickle.dumps(current))

    for number, (needle, _) in enumerate(pack.pairs):
        if not needle:
            continue
        if current is None or chars + len(needle) > MOST_CHARS:
            if current is not None:
                close()
            current, chars = ahocorasick.Automaton(), 0
        rules = [*current.get(needle, ((), ""))[0], number]
        current.add_word(needle, (tuple(rules), needle))
        chars += len(needle)
    if current is not None:
        close()
    return out


def in_word(c: str) -> bool:
    return c == "_" or unicodedata.category(c)[0] == "L" or unicodedata.category(c) == "Nd"


def bounded(text: str, start: int, end: int) -> bool:
    """Whether text[start:end] begins and ends at a boundary between letters, digits or _ (of any script, as Java 17 has it) and other characters."""
    edge = lambda i: (i > 0 and in_word(text[i - 1])) != (i < len(text) and in_word(text[i]))
    return edge(start) and edge(end)


def rule_numbers(spark, text: Column, pack: TagRules) -> Column:
    """Sorted numbers of the rules whose needle occurs in a text that is lower-cased already."""
    shared = [spark.sparkContext.broadcast(blob) for blob in automata(pack)]  # MOST_CHARS characters of needles each
    whole, empty = pack.whole_words, [i for i, (needle, _) in enumerate(pack.pairs) if not needle and not pack.whole_words]

    @F.arrow_udf("array<int>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machines = [pickle.loads(s.value) for s in shared]
        for batch in batches:
            out = []
            for value in batch.to_pylist():
                hits = set(empty)
                for machine in machines if value else ():
                    for end, (rules, needle) in machine.iter(value):
                        if not whole or bounded(value, end + 1 - len(needle), end + 1):
                            hits.update(rules)
                out.append(np.sort(np.fromiter(hits, np.int32, len(hits))))
            yield pa.array(out, pa.list_(pa.int32()))

    return find(text)


def tagged(df: DataFrame, text: Column, pack: TagRules, name: str) -> DataFrame:
    """``df`` plus the column ``name``: the same tags as ``extract.tags`` for packs of any size. (TXT-01, TXT-02, TXT-25)

    A text is read once per automaton, in time that grows with its length and its hits, not with the rules. The tags of the
    rules are looked up by number in a small table of the distinct tags, as a literal. Null texts are empty; extra columns pass through.
    """
    spark = df.sparkSession
    distinct = list(dict.fromkeys(tag for _, tag in pack.pairs))
    place = {tag: i for i, tag in enumerate(distinct)}
    by_rule = spark.sparkContext.broadcast(np.array([place[tag] for _, tag in pack.pairs], np.int32))
    names = spark.sparkContext.broadcast(distinct)

    @F.arrow_udf("array<string>")
    def named(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = (list(dict.fromkeys(by_rule.value[row].tolist())) for row in batch.to_pylist())
            yield pa.array([[names.value[i] for i in row] for row in rows], pa.list_(pa.string()))

    found = named(rule_numbers(spark, F.lower(F.coalesce(text, F.lit(""))), pack))
    out = df.withColumn(name, found)
    return out if pack.default is None else out.withColumn(name, F.when(F.size(name) == 0, F.array(F.lit(pack.default))).otherwise(F.col(name)))
