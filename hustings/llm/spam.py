"""Keyword-stuffed pages, link lists and product tags.

Method: the *robust Mahalanobis distance* of each text over features of density,
entropy, repetition and function words, per language; texts far out in the
directions of spam are flagged.  Centre and scale are medians and median
deviations, the scatter comes from clipped scores, all over the whole corpus.
Data, tables and citations deviate as well, but in directions of their own
(numbers, structure), so the share of a deviation that points to spam decides on
them.  An exact check follows: of the flagged texts those are cases more than
half of whose characters stand in repeated or strung-together keywords, lists of
links or product tags.  ``spam_steps`` tells how many texts each step leaves.

No text is ever shuffled or joined.  One scan takes the frequent short words of
languages without a fixed list, one the features, which are kept in the shared
folder beside the packed text and aggregated to a small model per language; then
the texts that are flagged by their features are unpacked and read.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.session import materialise, spread

# Frequent function words of each language; characters for Chinese.
FUNCTION_WORDS = {
    "en": "a an and any are as at be because been but by can did do for from had has have he her his how i if in into is it its may more most must no nor not of on one or our she so some than that the their there they this to two was we were what when where which who while will with would you",
    "fr": "a à alors au aux avec ce ces cette comme dans de des du elle elles en est et été être il ils je la le les leur lors mais n ne nous on ont ou où par pas plus pour qu que qui sa sans se ses son sont sous sur un une d l c s y",
    "es": "a al algo como con cuando de del desde donde dos el ella en entre era es esta este fue ha hasta hay la las lo los más mientras ni no o para pero por que quien se según ser sin sobre son su sus también un una y ya",
    "uk": "а або але без би був була було бути в вже від він вона вони все для до є з за із й і його її їх коли ми на не ні о об під по при про та так те то у хто це цей чи що як який які яка",
    "pa": "ਦਾ ਦੇ ਦੀ ਦੀਆਂ ਨੂੰ ਨੇ ਤੇ ਅਤੇ ਵਿੱਚ ਵਿਚ ਹੈ ਹਨ ਸੀ ਇਹ ਉਹ ਤੋਂ ਨਾਲ ਲਈ ਕਿ ਵੀ ਇਸ ਉਸ ਹੀ ਜੋ ਕਰ ਨਹੀਂ ਇੱਕ ਹੋ ਗਿਆ",
    "zh": "的 了 在 是 和 有 不 这 那 我 他 她 们 就 也 都 而 及 与 或 被 把 对 从 到 为 以 由 其 之 于 将 已 所 该 并 但",
}
#: The listed languages of a script; a text of another script, or of a language declared otherwise, takes its words from the corpus.
LISTED = {"latin": ("en", "fr", "es"), "cyrillic": ("uk",), "gurmukhi": ("pa",), "cjk": ("zh",)}
#: Scripts written without blanks: each character counts as a word.
SPACELESS = frozenset({"cjk", "hiragana", "katakana", "thai", "lao", "khmer", "myanmar", "tibetan"})
#: Words of a language without a list: so many of the most frequent ones of up to so many letters, each in this share of its texts, of at least so many texts.
LEARNED_WORDS, SHORT, COMMON, LEAST_TEXTS = 80, 5, 0.1, 20
#: A text is of a listed language if this share of its words is among that language's function words.
RECOGNISED = 0.12

FEATURES = ("links", "tags", "function_words", "repetition", "entropy", "sentences", "numbers", "structure")
#: The sign of each feature's deviation that points to spam.
DIRECTIONS = (1.0, 1.0, -1.0, 1.0, -1.0, -1.0, -1.0, -1.0)
#: Robust distances beyond this are outlying; scores are clipped at CLIP for the scatter.
CUTOFF, CLIP = 5.0, 2.5
#: The part of a deviation that lies in the directions of spam must make up this share of its length.
DIRECTED = 0.75
#: Languages with few texts lean on the model of all texts, as if that had so many texts of theirs.
LEANING = 200.0
#: Least scale of a feature.
LEAST_SCALE = 0.03
#: A case has more than half of its characters in spam.  The reading leaves out pieces cut off where spam meets other text, so
#: what it measures lies a little below; texts that are no cases lie well below.
SHARE = 0.45
#: The model of all texts, which also judges texts of no known language.
ALL = "*"


@lru_cache(maxsize=1)
def _marks() -> str:
    """Combining marks as a class; they belong to words in many scripts."""
    found = (cp for cp in range(0x300, sys.maxunicode + 1) if unicodedata.category(chr(cp)) in ("Mn", "Mc"))
    runs = ([cp for _, cp in run] for _, run in groupby(enumerate(found), lambda x: x[1] - x[0]))
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)


_URL = re.compile(r"(?:https?://|www\.)[^\s<>\"')\]]+|(?<![\w@.])(?:[\w-]+\.)+[a-z]{2,}/[^\s<>\"')\]]*", re.I)
_HOST = re.compile(r"\.[a-z]{2,}/", re.I)
_OTHER_SCRIPT = re.compile("[\u0370-\u1dff\u2c00-\ufdff\ufe70-\uffdc\U00010000-\U0001ffff\U00020000-\U0003ffff]")
_LETTER = re.compile(r"[^\W\d_]")
_FAST_WORD = re.compile(r"\w+")
_COMBINING = re.compile("[\u0300-\u036f]")
_MARKED_WORD = re.compile(rf"[\w{_marks()}]+")
_SPACELESS = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]")
_ANCHOR = re.compile(r"<a\s[^<>]*>[^<]*</a>|\[[^\[\]\n]+\]\([^()\s]+\)", re.I)
_MARKUP = re.compile(r"<[^<>\n]+>")
_TAG = re.compile(r"(?<!\w)#\w[\w.-]*")
_PRICE = re.compile(r"[$€£]\s?\d+[.,]\d\d\b|\bSKU\W?\d+", re.I)
_WORD = re.compile(rf"[^\W_][^\W_{_marks()}]*(?:['’][^\W_]+)*")
_NUMBER = re.compile(r"(?<![\w$])\d[\d,.:]*(?!\w)")
_YEAR = re.compile(r"(?:19|20)\d\d[,.:]?")
_LINE = re.compile(r"[^\r\n]+")
_SENTENCE = re.compile(r"(?<=[.!?…。！？।])[\"'”’)]*\s+")
_ENDED = re.compile(r"[.!?…。！？।][\"'”’)]*\s*$")
_LABEL = re.compile(r"^[^:：]+[:：]\s")

@lru_cache(maxsize=1 << 12)
def _script_of_character(c: str) -> str:
    return unicodedata.name(c, "latin").split()[0].split("-")[0].lower()


class Vocabulary:
    """Function words by script and language: the fixed lists, and what was learned of other languages."""

    def __init__(self, learned: Mapping[tuple[str, str], frozenset[str]] | None = None):
        self.languages = {script: {lang: frozenset(FUNCTION_WORDS[lang].split()) for lang in langs} for script, langs in LISTED.items()}
        for (script, lang), words in (learned or {}).items():
            self.languages.setdefault(script, {}).setdefault(lang, words)
        union = lambda scripts: frozenset(w for script in scripts for words in self.languages[script].values() for w in words)
        #: Function words of all languages written with blanks, and those that count in a text of each script.
        self.spaced = union(script for script in self.languages if script not in SPACELESS)
        self.known = {script: self.spaced | (union([script]) if script in SPACELESS else frozenset()) for script in self.languages}

    def of(self, script: str) -> frozenset[str]:
        return self.known.get(script, self.spaced)


LISTED_WORDS = Vocabulary()


def script_of(text: str) -> str:
    """The script that most of a text's letters are of, judged over the whole text; Latin unless three in ten are of another."""
    if text.isascii():
        return "latin"
    others = Counter(_OTHER_SCRIPT.findall(text))
    letters = Counter()
    for c, n in others.items():
        if c.isalpha():
            letters[_script_of_character(c)] += n
    if not letters:
        return "latin"
    script, n = max(letters.items(), key=lambda x: (x[1], x[0]))
    return script if n > 0.3 * len(_LETTER.findall(text)) else "latin"


def _code(declared: str | None) -> str:
    return (declared or "").strip().lower()[:2]


def language_of(script: str, counts: Counter, n: int, declared: str | None, vocabulary: Vocabulary = LISTED_WORDS) -> str | None:
    """The language of the script whose function words a text has most of, else the declared one, else None: no language is a default."""
    langs = vocabulary.languages.get(script, {})
    if len(langs) == 1 and script in LISTED:
        return next(iter(langs))
    hits = {lang: sum(counts[w] for w in counts.keys() & words) for lang, words in langs.items()}
    short = _code(declared)
    best = max(hits, key=lambda lang: (hits[lang], lang == short), default=None)
    if best is not None and hits[best] >= max(3, RECOGNISED * n):
        return best
    return short if short in langs else None


def _counted(text: str, script: str) -> Counter:
    """The words of a text in lower case; characters of spaceless scripts count singly, beside the words of others."""
    if script in SPACELESS:
        return Counter(_SPACELESS.findall(text) + _FAST_WORD.findall(_SPACELESS.sub(" ", text).lower()))
    return Counter((_FAST_WORD if script == "latin" and (text.isascii() or not _COMBINING.search(text)) else _MARKED_WORD).findall(text.lower()))


def measured(text: str, declared: str | None = None, vocabulary: Vocabulary = LISTED_WORDS) -> tuple[str | None, list[float]]:
    """The language and the features of a text, each feature between 0 and 1.  The text is gone over once."""
    size = len(text) or 1
    links = tags = 0
    rest = text
    if "/" in text and ("://" in text or "www." in text or _HOST.search(text)):
        rest, links = _URL.subn(" ", text)
    if "#" in rest:
        tags += sum(map(len, _TAG.findall(rest)))
    if "SKU" in rest or "$" in rest and (" / " in rest or " | " in rest or ", $" in rest or "; $" in rest):
        tags += 12 * len(_PRICE.findall(rest)) * (rest.count(" / ") + rest.count(" | ") + rest.count(", ") + rest.count("; ") > 2)
    script = script_of(rest)
    counts = _counted(rest, script)
    n = counts.total()
    language = language_of(script, counts, n, declared, vocabulary)
    dense = [links / (links + n) if links else 0.0, min(1.0, tags / size)]
    if n < 2:
        return language, [*dense, 0.0 if links or tags else 0.3, 0.0, 1.0, 0.0 if links or tags else 1.0, 0.0, 0.0]
    known = vocabulary.of(script)
    common = counts.keys() & known
    function = sum(map(counts.__getitem__, common))
    content = n - function
    repetition = 1.0 - math.log(len(counts) - len(common) + 1) / math.log(content + 1) if content else 0.0
    each = np.fromiter(counts.values(), np.float64, len(counts))
    entropy = (math.log(n) - float(each @ np.log(each)) / n) / math.log(n)
    ends = sum(map(rest.count, (". ", ".\n", "? ", "! ", "。", ".\r", "। "))) + rest.rstrip().endswith((".", "?", "!", "।"))
    numbers = sum(v for w, v in counts.items() if "0" <= w < ":")
    structure = 0 if links else sum(map(rest.count, ("\t", '"', "{", "}", ": ")))
    return language, [*dense, function / n, repetition, entropy, min(1.0, ends * 12 / n), numbers / n, min(1.0, structure / n)]


def _lines(text: str) -> Iterator[list[str]]:
    """The sentences of each line."""
    for line in _LINE.findall(text):
        parts = [part for part in _SENTENCE.split(line) if part.strip()]
        if parts:
            yield parts


def _varied(numbers: list[str]) -> bool:
    """Whether numbers are those of data: three or more, and not nearly all the same one; all years count as one."""
    if len(numbers) < 3:
        return False
    values = Counter("year" if _YEAR.fullmatch(n) else n.rstrip(".,:") for n in numbers)
    return max(values.values()) <= 0.75 * len(numbers)


class _Segment:
    """What a sentence, or a line without any, holds."""

    __slots__ = ("size", "linked", "links", "tags", "tag_size", "price", "data", "row", "formed", "told", "words", "lower", "function")

    def __init__(self, part: str, known: frozenset[str]):
        self.size = len("".join(part.split()))
        anchors = _ANCHOR.findall(part) if "](" in part or "<a" in part or "<A" in part else []
        rest = _ANCHOR.sub(" ", part) if anchors else part
        urls = _URL.findall(rest) if "/" in rest or "www." in rest else []
        rest = _URL.sub(" ", rest) if urls else rest
        rest = _MARKUP.sub(" ", rest) if "<" in rest else rest
        self.links = len(anchors) + len(urls)
        self.linked = sum(map(len, anchors)) + sum(map(len, urls))
        tags = _TAG.findall(rest) if "#" in rest else []
        self.tags, self.tag_size = len(tags), sum(map(len, tags))
        self.price = bool(_PRICE.search(rest))
        # Data and lines with several different numbers aren't made of keywords, whatever repeats in them; a row with tabs or in quotes
        # isn't, unless it repeats itself.  One number over and over, and years, come with keywords as well: there the words decide.
        self.row = not self.links and (part.lstrip()[:1] == '"' or "\t" in part.strip())
        self.data = not self.links and (part.lstrip()[:1] in "{}[]" or '":' in part or _varied(_NUMBER.findall(rest)))
        if self.data and not self.price:
            rest = ""  # its words are no keywords, so they needn't be looked at
        elif not self.links:
            # What a list's entries are labelled with repeats by nature; a label is no longer than what it labels.
            label = _LABEL.match(rest)
            rest = rest[label.end() :] if label and 2 * label.end() <= len(rest) else rest
        # Keywords are disguised by counters: the letters alone count.
        self.words = [w for w in (w.rstrip("0123456789") for w in _WORD.findall(rest)) if w]
        self.lower = [w.lower() for w in self.words]
        self.function = [w in known for w in self.lower]
        # The form of a sentence: an end mark, no small letter at the start, hardly a word twice.
        start = part.lstrip("-*•–—\"'“‘«(¡¿ \t")[:1]
        long = len(self.words) >= 5 or len(_SPACELESS.findall(rest)) >= 10
        self.formed = long and bool(_ENDED.search(part)) and start.isalpha() and not start.islower() and len(set(self.lower)) >= 0.8 * len(self.lower)
        self.told = " ".join(self.lower) if self.formed else ""


def _recurrent(places: dict, times: int, window: int) -> set[int]:
    """Places of what comes so many times within a window."""
    out: set[int] = set()
    for at in places.values():
        if len(at) >= times:
            for i, (first, last) in enumerate(zip(at, at[times - 1 :])):
                if last - first <= window:
                    out.update(at[i : i + times])
    return out


def spam_share(text: str, vocabulary: Vocabulary = LISTED_WORDS) -> float:
    """The share of a text's characters, blanks apart, that stand in keywords, link lists or product tags.

    Where a text has hardly a function word of a known language, sentences are told by their form instead.
    """
    known = vocabulary.of(script_of(text))
    lines = [[_Segment(part, known) for part in parts] for parts in _lines(text)]
    every = [s for line in lines for s in line]
    foreign = sum(map(sum, (s.function for s in every))) < RECOGNISED * sum(len(s.words) for s in every)
    told = Counter(s.told for s in every if s.formed)
    singles: dict[str, list[int]] = {}
    pairs: dict[tuple[str, str], list[int]] = {}
    at = links = 0
    for line in lines:
        for s in line:
            links += s.links
            before = None
            for w, function in zip(s.lower, s.function):
                if not function and len(w) > 1:
                    singles.setdefault(w, []).append(at)
                if before is not None:
                    pairs.setdefault((before, w), []).append(at)
                before = w
                at += 1
            at += 1  # no pair goes over a segment's end
    single, pair, twice = _recurrent(singles, 3, 60), _recurrent(pairs, 3, 60), _recurrent(pairs, 2, 40)

    total = spam = run = run_words = gap = at = 0
    bridged = 0
    for line in lines:
        prose = False
        for s in line:
            n = len(s.words)
            here = range(at, at + n)
            at += n + 1
            total += s.size
            content = sum(not f and len(w) > 1 for w, f in zip(s.words, s.function))
            again = sum(i in single for i in here)
            covered = [i in pair or i + 1 in pair and i + 1 < here.stop for i in here]
            free = sum(f and not c for f, c in zip(s.function, covered))
            flagged = listed = False
            if s.links:
                cited = prose and s.links == 1
                flagged = links >= 3 and not cited and s.linked >= 0.35 * s.size and (free <= 0.2 * n or s.links > 2 and s.linked >= 0.6 * s.size)
            elif s.tags:
                flagged = s.tag_size >= 0.5 * s.size
            elif s.data and not s.price:
                pass
            elif s.price and n >= 2 and sum(s.function) <= 0.2 * n:
                flagged = True
            else:
                inside = Counter(zip(s.lower, s.lower[1:])) if n >= 5 else {}
                twins = [inside[a] > 1 for a in zip(s.lower, s.lower[1:])] if n >= 5 else []
                within = sum(a or b for a, b in zip([*twins, False], [False, *twins])) if twins else 0
                # A sentence with its function words that repeats nothing in itself is prose, however often it is told.
                sentence = n >= 8 and sum(s.function) >= 0.25 * n and within < 0.3 * n
                # So is one of an unknown language by its form, unless it varies what stands around it; told again as a whole it doesn't.
                sentence = sentence or foreign and s.formed and within < 0.2 * n and (sum(covered) < 0.5 * n or told[s.told] > 1)
                if s.row:
                    flagged = n >= 5 and within >= 0.5 * n
                elif not sentence:
                    flagged = bool(content) and again >= 0.6 * content and free <= 0.34 * n
                    flagged = flagged or 2 <= n <= 7 and sum(covered) >= 0.6 * n
                    flagged = flagged or n >= 5 and within >= 0.5 * n
                flagged = flagged or not (s.row or sentence) and 2 <= n <= 6 and not any(s.function) and sum(i in twice or i + 1 in twice and i + 1 < here.stop for i in here) >= 0.6 * n
                if not (flagged or sentence) and n and not s.row and not any(s.function):
                    listed = sum(w.islower() or w[0].isdigit() for w in s.words) >= 0.9 * n
            prose = not flagged and not listed and (prose or not s.links)
            if listed:
                run, run_words = run + s.size, run_words + n
                continue
            spam += run if run_words >= 8 else 0
            run = run_words = 0
            # What stands singly between two flagged segments and isn't longer than either belongs to them.
            if flagged:
                spam += s.size + (gap if gap <= s.size else 0)
                gap, bridged = 0, s.size
            else:
                gap = s.size if s.size <= bridged and not (s.data or s.row) else 0
                bridged = 0
    spam += run if run_words >= 8 else 0
    return spam / total if total else 0.0


def _source(df: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    return rows.filter(F.col("doc_id").isNotNull() & F.col("text").rlike(r"(?U)\S"))


def _unlisted(text: Column, lang: Column) -> Column:
    """Whether a text may be of a language without a fixed list: declared so, or with letters of another script.  A coarse test in the JVM."""
    codes = [lang_code for langs in LISTED.values() for lang_code in langs]
    other = "[\\x{370}-\\x{3ff}\\x{530}-\\x{9ff}\\x{a80}-\\x{1dff}\\x{3040}-\\x{30ff}\\x{a490}-\\x{d7a3}]"
    code = F.substring(F.lower(F.trim(lang)), 1, 2)
    return ((code != "") & ~code.isin(*codes)) | text.rlike(other)


def learned_words(source: DataFrame) -> dict[tuple[str, str], frozenset[str]]:
    """{(script, language): words}: the frequent short words of languages without a fixed list, counted by text over the whole corpus.

    A language is a script and, for the scripts that lists are given for, the code a text is declared with.  Texts whose
    words are those of a listed language are left out.  At most ``LEARNED_WORDS`` words a language reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[str, str], Counter] = {}
            for text, declared in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                script = script_of(text)
                counts = _counted(text, script)
                code = _code(declared) if script in LISTED else ALL
                if not code or code in LISTED.get(script, ()) or language_of(script, counts, counts.total(), None):
                    continue
                here = seen.setdefault((script, code), Counter())
                here.update(w for w in counts if len(w) <= SHORT and w.isalpha())
                here[""] += 1  # the number of texts
            rows = [(script, code, w, n) for (script, code), words in seen.items() for w, n in words.items()]
            yield pa.RecordBatch.from_pylist([dict(zip(("script", "code", "word", "n"), r)) for r in rows], schema=_COUNTED)

    counted = spread(source.filter(_unlisted(F.col("text"), F.col("lang"))).select("text", "lang")).mapInArrow(count, "script string, code string, word string, n bigint")
    words = materialise(counted.groupBy("script", "code", "word").agg(F.sum("n").alias("n")))
    # Of each language the most frequent words and, under the empty word, its number of texts; ranked by aggregation, not in one task a language.
    texts = words.filter(f"word = '' AND n >= {LEAST_TEXTS}").select("script", "code", F.col("n").alias("texts"))
    known = words.filter("word <> ''").join(texts, ["script", "code"]).filter(F.col("n") >= COMMON * F.col("texts"))
    top = known.groupBy("script", "code").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "word")), asc=False), 1, LEARNED_WORDS).alias("top"))
    return {(r["script"], r["code"]): frozenset(x["word"] for x in r["top"]) for r in top.collect()}


_COUNTED = pa.schema([("script", pa.string()), ("code", pa.string()), ("word", pa.string()), ("n", pa.int64())])


def text_features(source: DataFrame, vocabulary: Vocabulary = LISTED_WORDS) -> DataFrame:
    """(doc_id, packed, language, features) of every text of (doc_id, text, lang); ``packed`` is the text compressed.

    Packing costs a few percent of what measuring does, so a text is measured once and read from there.
    """
    kind = source.schema["doc_id"].dataType.simpleString()

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            each = [measured(t, d, vocabulary) for t, d in zip(texts, batch.column(2).to_pylist())]
            values = np.array([v for _, v in each], np.float64).reshape(-1, len(FEATURES))
            packed = pa.array([zlib.compress(t.encode(), 1) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed, pa.array([x for x, _ in each], pa.string()), *(pa.array(np.ascontiguousarray(c)) for c in values.T)], names=["doc_id", "packed", "language", *FEATURES])

    return spread(source.select("doc_id", "text", "lang")).mapInArrow(featured, f"doc_id {kind}, packed binary, language string, " + ", ".join(f"{f} double" for f in FEATURES))


def robust_models(rows: DataFrame) -> dict[str, dict[str, np.ndarray]]:
    """Centre, scale and inverse scatter of the features per language, and of all texts under ``*``.

    Everything is aggregated over all rows; what reaches the driver is a few numbers for each language.
    """
    named = F.array_compact(F.array(F.col("language"), F.lit(ALL)))
    tagged = rows.select(F.explode(named).alias("language"), *FEATURES)
    # Medians, and median deviations from them.
    middle = {r["language"]: r for r in tagged.groupBy("language").agg(F.count(F.lit(1)).alias("n"), *(F.percentile_approx(f, 0.5, 10_000).alias(f) for f in FEATURES)).collect()}
    if not middle:
        return {}
    everything = np.array([middle[ALL][f] for f in FEATURES])
    lean = {k: r["n"] / (r["n"] + LEANING) if k != ALL else 1.0 for k, r in middle.items()}
    centre = {k: lean[k] * np.array([r[f] for f in FEATURES]) + (1 - lean[k]) * everything for k, r in middle.items()}

    def by_language(values: dict[str, np.ndarray], i: int) -> Column:
        held = F.create_map(*(F.lit(x) for k, v in values.items() for x in (k, float(v[i]))))
        return F.element_at(held, F.col("language"))

    off = [(F.col(f) - by_language(centre, i)) for i, f in enumerate(FEATURES)]
    aside = {r["language"]: r for r in tagged.groupBy("language").agg(*(F.percentile_approx(F.abs(x), 0.5, 10_000).alias(f) for x, f in zip(off, FEATURES))).collect()}
    own = {k: np.array([aside[k][f] for f in FEATURES]) for k in middle}
    scale = {k: np.maximum(LEAST_SCALE, 1.4826 * (lean[k] * own[k] + (1 - lean[k]) * own[ALL])) for k in middle}

    # The scatter of scores clipped on both sides.
    z = [F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), x / by_language(scale, i))) for i, x in enumerate(off)]
    sums = tagged.groupBy("language").agg(*(F.avg(z[i] * z[j]).alias(f"m{i}_{j}") for i in range(len(FEATURES)) for j in range(i + 1)))
    scatter = {r["language"]: np.array([[r[f"m{max(i, j)}_{min(i, j)}"] for j in range(len(FEATURES))] for i in range(len(FEATURES))]) for r in sums.collect()}
    unit = np.eye(len(FEATURES))
    models = {}
    for k in middle:
        s = lean[k] * scatter[k] + (1 - lean[k]) * scatter[ALL] + 0.1 * unit
        d = np.sqrt(np.diag(s))
        models[k] = {"centre": centre[k], "scale": scale[k], "inverse": np.linalg.inv(s / np.outer(d, d))}
    return models


def outlying(values: np.ndarray, model: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The robust distance of each row, and the share of its deviation in the directions of spam."""
    z = (values - model["centre"]) / model["scale"]
    distance = np.sqrt(np.einsum("ij,jk,ik->i", z, model["inverse"], z).clip(0))
    towards = np.maximum(0.0, z * np.array(DIRECTIONS))
    # More sentence ends than usual speak neither for spam nor against it: stuffed sentences are short.
    against = np.minimum(0.0, z * np.array(DIRECTIONS)) * (np.array(FEATURES) != "sentences")
    along = np.linalg.norm(towards, axis=1)
    return distance, along / np.maximum(1e-12, np.hypot(along, np.linalg.norm(against, axis=1)))


def judged(rows: DataFrame, models: dict[str, dict[str, np.ndarray]], vocabulary: Vocabulary, cutoff: float = CUTOFF, directed: float = DIRECTED) -> DataFrame:
    """(doc_id, distance, towards, share): every text judged by its features; ``share`` is read of those flagged and null for others."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(2).to_pylist()
            langs, values = np.array(names, object), np.column_stack([batch.column(3 + i).to_numpy(zero_copy_only=False) for i in range(len(FEATURES))])
            distance, towards = np.zeros(len(langs)), np.zeros(len(langs))
            for k in set(names):
                at = np.flatnonzero(langs == k)
                distance[at], towards[at] = outlying(values[at], models.get(k, models[ALL]))
            flagged, packed = (distance > cutoff) & (towards >= directed), batch.column(1)
            shares = [spam_share(zlib.decompress(packed[i].as_py()).decode(), vocabulary) if f else None for i, f in enumerate(flagged)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(distance), pa.array(towards), pa.array(shares, pa.float64())], names=["doc_id", "distance", "towards", "share"])

    return rows.select("doc_id", "packed", "language", *FEATURES).mapInArrow(judge, f"doc_id {kind}, distance double, towards double, share double")


def _judged(df: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    source = _source(df, doc_id, text, lang)
    vocabulary = Vocabulary(learned_words(source))
    rows = materialise(text_features(source, vocabulary))
    models = robust_models(rows)
    if not models:
        return rows.select("doc_id", *(F.lit(None).cast("double").alias(c) for c in ("distance", "towards", "share")))
    return judged(rows, models, vocabulary)


def spam_pages(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", share: float = SHARE) -> DataFrame:
    """(doc_id, distance, share): flagged texts more than ``share`` of whose characters are keywords, link lists or product tags.

    Null, empty and blank texts are no cases, nor are rows without id.  Rows repeated under one id are judged each on their own
    text and told once.
    """
    found = _judged(df, doc_id, text, lang).filter(F.col("share") > share)
    return found.groupBy("doc_id").agg(F.max("distance").alias("distance"), F.max("share").alias("share")).withColumnRenamed("doc_id", doc_id)


def spam_steps(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", share: float = SHARE) -> DataFrame:
    """(step, n): how many texts are judged, lie far out, lie far out in the directions of spam, and are cases."""
    counts = _judged(df, doc_id, text, lang).agg(
        F.count("distance").alias("judged"), F.count_if(F.col("distance") > CUTOFF).alias("outlying"), F.count("share").alias("flagged"), F.count_if(F.col("share") > share).alias("cases")
    )
    return counts.unpivot([], ["judged", "outlying", "flagged", "cases"], "step", "n")
