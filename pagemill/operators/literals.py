"""Many patterns against many texts, by what each pattern cannot do without.

A pattern's longest required literal is looked for in all texts by an automaton for all literals
together, in one pass over a text however many patterns there are. Only the patterns whose
literal was found are then tried, by an equality join. A pattern without a literal is tried on every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill import ship

#: Literals of one automaton. More of them are looked for in several passes.
AUTOMATON = 200_000


# Escapes of more than one character after the backslash.
LONGER = re.compile(r"[pP](?:\{[^}]*\}|.)|x(?:\{[^}]*\}|..)|u....|[kN](?:<[^>]*>|\{[^}]*\})|c.|0[0-7]{1,3}|[1-9][0-9]*", re.S)


def required(pattern: str | None) -> str:
    """The longest run of characters that every match holds, as far as that can be read off plainly; else the empty text.

    What it takes for certain is a plain character outside groups and classes that no quantifier makes optional; alternatives on the top level and flags give nothing."""
    best, run, i, p = "", "", 0, pattern or ""

    def done() -> None:
        nonlocal best, run
        best, run = max(best, run, key=len), ""

    while i < len(p):
        c, literal = p[i], None
        if c == "|" or p.startswith("(?", i) and p[i + 2 : i + 3] not in (":", "=", "!", "<", ">"):
            return ""
        if c == "\\":
            e = p[i + 1 : i + 2]
            if e == "Q":
                end = p.find("\\E", i)
                quoted = p[i + 2 : end if end >= 0 else len(p)]
                i = (end + 2) if end >= 0 else len(p)
                follows = p[i : i + 1]
                run += quoted[:-1] if follows in ("?", "*", "{", "+") else quoted
                if follows in ("?", "*", "{", "+"):
                    done()
                continue
            i += 2
            if e and not e.isalnum():
                literal = e
            elif m := LONGER.match(p, i - 1):
                i = m.end()
        elif c == "[":
            depth, i = 1, i + 1
            if p[i : i + 1] == "^":
                i += 1
            if p[i : i + 1] == "]":
                i += 1
            while i < len(p) and depth:
                if p[i] == "\\":
                    i += 1
                depth += (p[i : i + 1] == "[") - (p[i : i + 1] == "]")
                i += 1
        elif c == "(":
            depth, i = 1, i + 1
            while i < len(p) and depth:
                if p[i] == "\\":
                    i += 1
                elif p[i] == "[":  # brackets in a class are plain
                    i += 2 if p[i + 1 : i + 2] == "]" else 1
                    while i < len(p) and p[i] != "]":
                        i += 2 if p[i] == "\\" else 1
                depth += (p[i : i + 1] == "(") - (p[i : i + 1] == ")")
                i += 1
        else:
            i += 1
            if c not in ".^$?*+{})]":
                literal = c
            elif c in "?*+":
                done()
                continue
            elif c == "{":
                i = p.find("}", i) + 1 or len(p)
                done()
                continue
        follows = p[i : i + 1]
        if literal is None or follows in ("?", "*", "{"):
            done()
        else:
            run += literal
            if follows == "+":
                done()
    done()
    return best


_made: dict[int, object] = {}


def automaton(literals: list[str], key: int):
    """One for each list in a worker, as long as the list is the same."""
    if key not in _made:
        import ahocorasick

        a = ahocorasick.Automaton()
        for x in literals:
            a.add_word(x, x)
        a.make_automaton()
        _made.clear()
        _made[key] = a
    return _made[key]


def finder(literals: list[str]):
    key = hash((len(literals), *literals))

    @F.pandas_udf("array<string>")
    def found(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a = automaton(literals, key)
        for texts in it:
            yield pd.Series([[] if t is None else sorted({x for _, x in a.iter(t)}) for t in texts], dtype=object)

    return found


def matches(df: DataFrame, subject: str, rules: DataFrame, pattern: str = "pattern", on: tuple[str, ...] = (), literals_at_once: int = AUTOMATON) -> DataFrame:
    """The rows of ``df`` with those of ``rules`` whose pattern matches the whole subject (and that are equal in ``on``), of any number."""
    ship.ensure(df.sparkSession)

    @F.pandas_udf("string")
    def literal(p: pd.Series) -> pd.Series:
        return p.map(required)

    tried = rules.where(F.col(pattern).isNotNull()).withColumn("_literal", literal(pattern))
    counted = tried.agg(F.count_distinct(F.when(F.col("_literal") != "", F.col("_literal"))).alias("n"), F.max(F.col("_literal") == "").alias("rest")).first()
    blocks = max(1, -(-counted["n"] // literals_at_once))
    got = []
    for k in range(blocks if counted["n"] else 0):
        some = tried.where(F.col("_literal") != "").select("_literal").distinct().where(F.pmod(F.xxhash64("_literal"), F.lit(blocks)) == k)
        got.append(finder(sorted(r[0] for r in some.collect()))(F.col(subject)))
    always = F.array(F.lit("")) if counted["rest"] else F.expr("cast(array() as array<string>)")
    met = df.where(F.col(subject).isNotNull()).withColumn("_literal", F.explode(F.concat(always, *got))).join(tried, ["_literal", *on])
    return met.where(F.expr(f"{subject} rlike concat('^(?:', {pattern}, ')$')")).drop("_literal")
