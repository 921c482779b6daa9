"""Visually identical text in one consistent form.

Method: a *quick check* finds the segments of a text that aren't stable under
normalisation; only those are normalised, each with the character before it as
boundary context, and spliced into the unchanged rest.  A coarser check runs in
the JVM first, so a text of stable blocks alone never reaches Python.

Two forms are given.  The comparison key: canonically composed (NFC); full-width, half-width and presentation
forms, ligatures and one-letter numerals as their ordinary characters; letters
of other scripts that look like a Latin one as that one; every kind of blank as
a space, runs of them as one and none at the ends; every kind of hyphen as ``-``;
invisible characters left out.  Letter case, accents and visible punctuation stay.
The text form is the same but for look-alike letters, which it replaces only in
words that mix them with Latin ones: a word of another script stays what it is.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.operators.relational import control
from hustings.session import materialise, spread

# Letters that look like a Latin letter, after the confusables of Unicode Technical Standard 39.
LOOKALIKES = {
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνορϲϳ": "ABEZHIKMNOPTYXvopcj",
    "АВЕЅІЈКМНОРСТУХҮӀԌԚԜ": "ABESIJKMHOPCTYXYIGQW",
    "асԁеһіјӏорԛѕухѵԝ": "acdehijlopqsyxvw",
    "ՍՏՕսհոօզց": "USOuhnoqg",
    "ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏚᎢᏙᎳᏃ": "ABCDEGHJKLMPSTVWZ",
    "ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ": "BPDTGKJCZFMNLSRVHWXYAEIOU",
    "ⲀⲂⲈⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ": "ABEHIKMNOPCTYXopc",
    "ɡɑ": "ga",
}
HYPHENS = "\u2010\u2011\u2012\u2013\u2212\u02d7\u2043\ufe58\ufe63"
#: Invisible characters that aren't of the category Cf, and visible ones that are.
INVISIBLE = "\u034f\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180f\u3164\uffa0"
VISIBLE_FORMATS = "\u0600\u0601\u0602\u0603\u0604\u0605\u06dd\u070f\u0890\u0891\u08e2"
#: Tags of compatibility decompositions that keep the look.
KEPT_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>", "<compat>")


def _letters() -> dict[str, str]:
    return {a: b for source, target in LOOKALIKES.items() for a, b in zip(source, target, strict=True)} | dict.fromkeys(HYPHENS, "-")


_LETTER = _letters()


#: Blocks without any unstable character; texts within them pass a check of a few comparisons a character.
STABLE_BLOCKS = ((0x9, 0xA), (0xD, 0xD), (0x20, 0x7E), (0xC0, 0x131), (0x14A, 0x17E), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3))


@lru_cache(maxsize=1 << 17)
def _of_character(c: str, letters: bool = True) -> str:
    """What one character stands for, before composition; ``letters``: look-alikes stand for the Latin letter."""
    category = unicodedata.category(c)
    if c in INVISIBLE or (category == "Cf" and c not in VISIBLE_FORMATS) or (category == "Cc" and c not in "\t\n\r") or "\ufe00" <= c <= "\ufe0f" or "\U000e0100" <= c <= "\U000e01ef":
        return ""
    if category == "Zs" and c != " ":
        return " "
    if c in "\u2028\u2029":
        return "\n"
    tag, _, rest = unicodedata.decomposition(c).partition(" ")
    if tag in KEPT_LOOK:
        wide = "".join(chr(int(x, 16)) for x in rest.split())
        if " " not in wide:
            return "".join(_of_character(x, letters) for x in wide)
    return "".join(_LETTER.get(x, x) if letters or x in HYPHENS else x for x in unicodedata.normalize("NFD", c))


@lru_cache(maxsize=1 << 16)
def normal_segment(segment: str, letters: bool = True) -> str:
    return unicodedata.normalize("NFC", "".join(_of_character(c, letters) for c in segment))


def reference_form(text: str, letters: bool = True) -> str:
    """The whole text normalised at once: what splicing has to give."""
    return _unmixed(unicodedata.normalize("NFC", "".join(_of_character(c, letters) for c in text)), letters)


_FOREIGN = re.compile("[" + "".join(k for k in _LETTER if k not in HYPHENS) + "]")
_WORD = re.compile(r"\w+(?:['’]\w+)*")


def _unmixed(text: str, letters: bool) -> str:
    """Look-alikes replaced in words that hold Latin letters too; nothing to do where all have been replaced."""
    if letters or not _FOREIGN.search(text):
        return text
    mixed = lambda m: unicodedata.normalize("NFC", "".join(_LETTER.get(c, c) for c in unicodedata.normalize("NFD", m.group()))) if re.search("[A-Za-z]", m.group()) and _FOREIGN.search(m.group()) else m.group()
    return _WORD.sub(mixed, text)


@lru_cache(maxsize=1)
def unstable_ranges() -> tuple[tuple[int, int], ...]:
    """Ranges of characters that don't pass the quick check: changed by themselves, combining, or able to compose with what stands before them."""
    seconds = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    flagged = []
    for cp in range(0x80, sys.maxunicode + 1):
        c = chr(cp)
        category = unicodedata.category(c)
        if category in ("Cn", "Co", "Cs"):
            continue
        parts = unicodedata.decomposition(c)
        if parts and parts[0] != "<" and " " in parts:
            seconds.add(int(parts.split()[1], 16))
        if unicodedata.combining(c) or reference_form(c) != c:
            flagged.append(cp)
    flagged = sorted({*flagged, *seconds, *(cp for cp in range(0x20) if cp not in (9, 10, 13)), 0x7F})
    ranges: list[list[int]] = []
    for cp in flagged:
        if ranges and ranges[-1][1] == cp - 1:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    return tuple((a, b) for a, b in ranges)


@lru_cache(maxsize=1)
def _class() -> str:
    one = "\\U{:08x}".format
    return "".join(one(a) if a == b else f"{one(a)}-{one(b)}" for a, b in unstable_ranges())


def outside_stable_blocks() -> str:
    """The regular expression by which the JVM finds texts that may hold an unstable segment; a long class would cost microseconds a character."""
    if any(a <= high and low <= b for low, high in STABLE_BLOCKS for a, b in unstable_ranges()):
        raise AssertionError("a stable block holds an unstable character")
    return "[^" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in STABLE_BLOCKS) + "]"


@lru_cache(maxsize=4)
def _segments(python_class: str) -> re.Pattern:
    # The character before belongs to the segment: a mark may compose with it.
    return re.compile(f"[^{python_class}]?[{python_class}]+")


def splice(text: str, python_class: str | None = None, letters: bool = True) -> str:
    """``text`` with its unstable segments normalised and the rest untouched."""
    return _unmixed(_segments(python_class or _class()).sub(lambda m: normal_segment(m.group(), letters), text), letters)


def canonical_text(text: Column, single_line: bool = False, key: bool = True) -> Column:
    """The consistent form of a text column; null stays null.

    ``single_line``: tabs and line ends are blanks too, as in labels and names.  ``key``: the comparison key, in which look-alike
    letters of other scripts are the Latin ones; without it the text form, fit to be read and trained on.
    """
    ours = _class()

    @F.pandas_udf("string")
    def spliced(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else splice(t, ours, key), na_action="ignore")

    unstable = text.rlike(outside_stable_blocks())
    form = F.when(unstable, spliced(F.when(unstable, text))).otherwise(text)
    form = F.regexp_replace(form, "[ \t\r\n]+" if single_line else " {2,}", " ")
    return F.trim(form)


#: Rows of one class that are paired in one task are about so many times those of the class; larger classes are split.
PAIRED_TOGETHER = 2_000


def _hashed(columns: Sequence[str], seed: str) -> Column:
    """64 bits of several columns, told apart by their places."""
    return F.xxhash64(F.lit(seed), *(v for i, c in enumerate(columns) for v in (F.lit(i), F.col(c))))


def _members(df: DataFrame, row_id: str, same: Sequence[str], looks: Sequence[str]) -> DataFrame:
    """(id, g1, g2, w, n): rows of classes that are written in several ways; 128 bits for the class, 64 for the writing within it, no text.

    A class is ``same`` and the comparison keys of ``looks``.  Classes are looked for by the first 64 bits, which at worst keeps a row too
    many, and the rows are picked without a shuffle while the classes are few, which is counted.
    """
    s, c, x = ([f"{p}{i}" for i in range(len(n))] for p, n in (("s", same), ("c", looks), ("x", looks)))
    rows = spread(df).select(F.col(row_id).alias("id"), *(F.col(n).alias(a) for n, a in zip(same, s)), *(F.col(n).alias(a) for n, a in zip(looks, x))).dropna()
    rows = rows.select("id", *s, *x, *(canonical_text(F.col(a), single_line=True).alias(b) for a, b in zip(x, c)))
    rows = materialise(rows.select("id", *(_hashed([*s, *c], seed).alias(f"g{seed}") for seed in "12"), _hashed(x, "w").alias("w")))
    several = rows.groupBy("g1").agg(F.min("w").alias("least"), F.max("w").alias("most"), F.count(F.lit(1)).alias("n")).filter("least <> most").select("g1", "n")
    return rows.join(control(materialise(several)), "g1")


def lookalike_classes(df: DataFrame, row_id: str, same: Sequence[str], looks: Sequence[str]) -> DataFrame:
    """(class_id, id, writing): the rows of every class that is written in several ways; ``class_id`` is its least id, ``writing`` the least id written so.

    As large as its part of the input, however many pairs a class holds.  Rows with a null in any of these columns are in no class;
    a row repeated under one id is one row.
    """
    members = materialise(_members(df, row_id, same, looks).select("id", "g1", "g2", "w").dropDuplicates())
    classes = members.groupBy("g1", "g2", "w").agg(F.min("id").alias("writing"))
    least = classes.groupBy("g1", "g2").agg(F.min("writing").alias("class_id"), F.count(F.lit(1)).alias("writings")).filter("writings > 1").drop("writings")
    return members.join(classes, ["g1", "g2", "w"]).join(least, ["g1", "g2"]).select("class_id", F.col("id").alias(row_id), "writing")


def lookalike_pairs(df: DataFrame, row_id: str, same: Sequence[str], looks: Sequence[str], paired_together: int = PAIRED_TOGETHER) -> DataFrame:
    """(id_a, id_b), id_a < id_b: rows equal in ``same`` whose ``looks`` look the same while one of them differs in its characters.

    Rows with a null in any of these columns pair with none.  Classes all of whose rows are written alike are left
    out before any pairing; rows written alike never pair, so what a class gives is as large as the result.  Large classes are
    split, one side by a salt that the other side is repeated for.  A row repeated under one id pairs as one.
    """
    members = materialise(_members(df, row_id, same, looks).withColumn("salts", F.greatest(F.lit(1), F.ceil(F.col("n") / paired_together)).cast("int")).drop("n"))
    a = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts").cast("bigint")).cast("int")).alias("a")
    b = members.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("b")
    pairs = a.join(b, F.expr("a.g1 = b.g1 AND a.g2 = b.g2 AND a.salt = b.salt AND a.id < b.id AND a.w <> b.w"))
    return pairs.select(F.col("a.id").alias(f"{row_id}_a"), F.col("b.id").alias(f"{row_id}_b")).distinct()
