"""Names and labels as column expressions: cleaning, splitting, display and order.  All of it is built in; nothing runs in Python."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes of a surname, particles that begin one, and punctuation allowed in a name.
SUFFIXES = ("jr", "sr", "ii", "iii", "iv")
PARTICLES = ("da", "de", "del", "della", "der", "di", "dos", "du", "la", "le", "st", "st.", "ten", "ter", "van", "vander", "vanden", "von")
PUNCTUATION = " -,.'’()"
# A given name must be this common, and a surname this many times commoner, to decide on a middle name.
GIVEN_RARE, GIVEN_UNCOMMON, SURNAME_TIMES = 1000, 300, 6
# The formats a list of names is published in, the tail that tells pronouns, the word for a withdrawn nomination, and an initial.
FORMATS = ("first_last", "last_first", "caps_surname", "pre_split")
PRONOUN_TAIL = r"(?iU),\s*(she|he|they|ze)/\w+\s*$"
WITHDRAWN = "(?i)withdraw"
INITIAL = r"^[A-Za-zÀ-ÿ]\.?(?:[A-Za-zÀ-ÿ]\.)*$"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it stands there; without this, expressions grow by every use of a use."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def norm(c: Column) -> Column:
    """Null as blank, runs of any white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def is_suffix(token: Column) -> Column:
    return F.regexp_replace(F.lower(token), r"^\.+|\.+$", "").isin(*SUFFIXES)


def without_pronouns(c: Column) -> Column:
    return F.regexp_replace(c, PRONOUN_TAIL, "")


def is_withdrawn(c: Column) -> Column:
    return c.rlike(WITHDRAWN)


def _name(last: Column, first: Column) -> Column:
    return F.struct(F.trim(last).alias("last"), F.trim(first).alias("first"))


def _words(tokens: Column, start, n) -> Column:
    """``n`` tokens from a place on, joined by blanks; none if ``n`` is below 1."""
    return F.array_join(F.slice(tokens, F.greatest(F.lit(1), F.lit(start) if isinstance(start, int) else start), F.greatest(F.lit(0), F.lit(n) if isinstance(n, int) else n)), " ")


def split_last_first(c: Column) -> Column:
    """(last, first) of ``Last, First``; a suffix with a comma of its own stays with the surname; without a comma all is surname.

    Parts are kept even if empty: of ``A,,B`` the given name is ``, B``.
    """

    def split(parts: Column) -> Column:
        suffixed = (F.size(parts) >= 3) & is_suffix(F.get(parts, F.lit(1)))
        rest = lambda n: F.array_join(F.slice(parts, n + 1, F.greatest(F.size(parts) - n, F.lit(0))), ", ")
        last = F.when(suffixed, F.concat(parts[0], F.lit(", "), F.get(parts, F.lit(1)))).otherwise(parts[0])
        return F.struct(last.alias("last"), F.when(suffixed, rest(2)).otherwise(rest(1)).alias("first"))

    return let(F.transform(F.split(c, ","), lambda p: F.trim(p)), split)


def split_caps_surname(c: Column, ranks: Column | None = None) -> Column:
    """(last, first) where the surname is set in capitals: it starts with the first capitalised token.

    Where no token or every token is capitalised the capitals tell nothing, and the name is split as ``split_first_last`` does.
    """

    def split(tokens: Column) -> Column:
        caps = F.transform(tokens, lambda t: (F.length(t) > 1) & (t == F.upper(t)) & t.rlike("[A-ZÀ-Þ]"))
        return let(F.struct(F.array_position(caps, F.lit(True)).cast("int").alias("at"), F.array_contains(caps, False).alias("others")), lambda x: divided(tokens, x["at"], x["others"]))

    def divided(tokens: Column, at: Column, others: Column) -> Column:
        told = F.struct(_words(tokens, at, F.size(tokens) - at + 1).alias("last"), _words(tokens, 1, at - 1).alias("first"))
        return F.when((at > 0) & others, told)

    return F.coalesce(let(F.split(norm(c), " "), split), split_first_last(c, ranks))


def is_initial(token: Column) -> Column:
    """``J.``, ``C`` or ``R.E.``: a letter, and after it letters each with a dot."""
    return token.rlike(INITIAL)


def rank_token(token: Column) -> Column:
    """A token as rank tables hold it: word characters, apostrophes and hyphens, in lower case."""
    return F.lower(F.regexp_replace(token, r"(?U)[^\w'-]", ""))


def middle_verdict(token: Column, given_rank: Column, surname_rank: Column) -> Column:
    """(surname_like, why, close) of a middle name by the ranks of its token among given names and surnames; a lower rank is commoner.

    ``close`` marks calls worth a look: the token joined the surname, or it is at least as common as a surname.
    """
    like = lambda verdict, why, close=False: F.struct(F.lit(verdict).alias("surname_like"), F.lit(why).alias("why"), (close if isinstance(close, Column) else F.lit(close)).alias("close"))
    return (
        F.when(is_initial(token), like(False, "initial"))
        .when(surname_rank.isNull(), like(False, "no surname"))
        .when(given_rank.isNull(), like(True, "no given name", True))
        .when(given_rank > GIVEN_RARE, like(True, "rare given name", True))
        .when((given_rank > GIVEN_UNCOMMON) & (surname_rank * SURNAME_TIMES < given_rank), like(True, "commoner surname", True))
        .otherwise(like(False, "given name", surname_rank <= given_rank))
    )


def name_parts(c: Column) -> Column:
    """(first, middles, particles_on, suffix, nickname) of ``First Middle Last``.

    A nickname in brackets or quotes is set aside, a suffix at the end too, with or without a comma; ``particles_on`` is the
    surname from its particles on, as particles begin a surname, and ``middles`` what stands between.
    """
    # A nickname is what stands in round brackets or in double quotes, apart from the words around it.
    mark = r"(?:\(([^()]*)\)|\"([^\"]*)\"|“([^”]*)”)"
    nick = F.trim(F.concat(*(F.regexp_extract(c, mark, i) for i in (1, 2, 3))))
    bare = norm(F.regexp_replace(c, mark, " "))
    tokens = F.filter(F.split(F.regexp_replace(bare, r"\s*,\s*", " "), " "), lambda t: t != "")

    def cored(tokens: Column) -> Column:
        n = F.size(tokens)
        return let(F.when((n > 2) & is_suffix(F.element_at(tokens, -1)), n - 1).otherwise(n), lambda core: begun(tokens, n, core))

    def begun(tokens: Column, n: Column, core: Column) -> Column:
        # The surname begins at the first particle after the given name, else at the last token.
        particle = F.array_position(F.transform(tokens, lambda t, i: (i > 0) & (i < core - 1) & F.lower(t).isin(*PARTICLES)), F.lit(True)).cast("int")
        return let(F.coalesce(F.nullif(particle, F.lit(0)), core), lambda start: parted(tokens, n, core, start))

    def parted(tokens: Column, n: Column, core: Column, start: Column) -> Column:
        return F.struct(
            F.when(n > 1, F.get(tokens, F.lit(0))).otherwise("").alias("first"),
            F.slice(tokens, 2, F.greatest(start - 2, F.lit(0))).alias("middles"),
            F.when(n > 1, _words(tokens, start, core - start + 1)).otherwise(F.array_join(tokens, " ")).alias("surname"),
            F.when(core < n, F.element_at(tokens, -1)).otherwise("").alias("suffix"),
            nick.alias("nickname"),
        )

    return let(tokens, cored)


def _ranks_of(ranks: Column | None, token: Column) -> tuple[Column, Column]:
    if ranks is None:
        return F.lit(None).cast("int"), F.lit(None).cast("int")
    found = F.try_element_at(ranks, rank_token(token))
    return found["given_rank"], found["surname_rank"]


def split_first_last(c: Column, ranks: Column | None = None) -> Column:
    """(last, first) of ``First Middle Last``: suffix and particles belong to the surname, a nickname to the given name.

    Middle names are voted on one by one from the right and join the surname until one doesn't read as a surname.
    ``ranks``: map<token, struct<given_rank, surname_rank>> of the row's tokens (``rank_token``); without it none joins.
    """

    def split(parts: Column) -> Column:
        likes = F.transform(parts["middles"], lambda t: middle_verdict(t, *_ranks_of(ranks, t))["surname_like"])
        # As many stay as stand before the last one that doesn't join.
        stays = F.array_max(F.transform(likes, lambda x, i: F.when(x, 0).otherwise(i + 1)))
        return let(F.coalesce(stays, F.lit(0)), lambda kept: joined(parts, kept))

    def joined(parts: Column, kept: Column) -> Column:
        middles = parts["middles"]
        last = F.concat_ws(" ", F.nullif(_words(middles, kept + 1, F.size(middles) - kept), F.lit("")), parts["surname"], F.nullif(parts["suffix"], F.lit("")))
        nickname = F.when(parts["nickname"] != "", F.concat(F.lit("("), parts["nickname"], F.lit(")")))
        first = F.concat_ws(" ", F.nullif(parts["first"], F.lit("")), F.nullif(_words(middles, 1, kept), F.lit("")), nickname)
        return F.when(parts["surname"] == "", F.struct(norm(c).alias("last"), F.lit("").alias("first"))).otherwise(_name(last, first))

    return let(name_parts(c), split)


def close_calls(c: Column, ranks: Column | None = None) -> Column:
    """The middle names of ``First Middle Last`` voted on whose call was close: (token, surname_like, why)."""
    middles = F.reverse(name_parts(c)["middles"])
    votes = F.transform(middles, lambda t: F.struct(t.alias("token"), middle_verdict(t, *_ranks_of(ranks, t)).alias("v")))
    # Voting stops at the first that stays with the given name.
    stop = F.array_position(F.transform(votes, lambda x: ~x["v"]["surname_like"]), F.lit(True)).cast("int")
    asked = F.when(stop > 0, F.slice(votes, 1, F.greatest(stop, F.lit(1)))).otherwise(votes)
    return F.transform(F.filter(asked, lambda x: x["v"]["close"]), lambda x: F.struct(x["token"].alias("token"), x["v"]["surname_like"].alias("surname_like"), x["v"]["why"].alias("why")))


def split_name(name_format: Column, c: Column, ranks: Column | None = None) -> Column:
    """(last, first) by the format a list is published in, ``first_last`` where none is given.

    An unknown format fails: a rule over the input (``name format known``) tells it before.
    """
    told = F.coalesce(name_format, F.lit("first_last"))

    def split(clean: Column) -> Column:
        return (
            F.when(told.isin("last_first", "pre_split"), split_last_first(clean))
            .when(told == "caps_surname", split_caps_surname(clean, ranks))
            .when(told == "first_last", split_first_last(clean, ranks))
            .otherwise(F.raise_error(F.concat(F.lit("unknown name format: "), told)).cast("struct<last: string, first: string>"))
        )

    return let(F.trim(without_pronouns(norm(c))), split)


def candidate(name_format: Column, c: Column, ranks: Column | None = None) -> Column:
    """(name_raw, last_name, first_name): the surname in capitals, the given name as published; one without a letter is none."""

    def shown(name: Column) -> Column:
        first = F.when(name["first"].rlike(r"(?U)\w"), name["first"]).otherwise("")
        return F.struct(norm(c).alias("name_raw"), F.upper(name["last"]).alias("last_name"), first.alias("first_name"))

    return let(split_name(name_format, c, ranks), shown)


def display_name(last: Column, first: Column) -> Column:
    return F.when(F.coalesce(first, F.lit("")) != "", F.concat_ws(", ", last, first)).otherwise(last)


def is_well_formed(name: Column) -> Column:
    """Neither blank, nor with blanks or commas at the ends."""
    return F.coalesce((name != "") & (name == F.trim(name)) & ~name.rlike("^,|,$"), F.lit(False))


def odd_characters(name: Column) -> Column:
    """Characters that are neither letters, digits nor ranked punctuation."""
    return F.regexp_replace(name, rf"[\p{{L}}\p{{N}}\p{{M}}{re.escape(PUNCTUATION)}]", "")


def integers(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"\d+"), F.lit(0))


def label_parts(label: Column, word: str = "Ward ") -> Column:
    """The single labels that a joint one such as ``Wards 1, 5`` stands for."""
    return F.transform(integers(label), lambda n: F.concat(F.lit(word), n))


def positive_count(c: Column) -> Column:
    """A whole number above 0, else null."""
    return F.nullif(F.when(F.trim(c).rlike(r"^\d+$"), F.trim(c).try_cast("bigint")), F.lit(0))


def url_list(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda u: F.trim(u)), lambda u: u != "")


def script_literal(c: Column) -> Column:
    """Text with the characters escaped that end a quoted literal."""
    out = c
    for ch in "()'":
        out = F.replace(out, F.lit(ch), F.lit("\\" + ch))
    return out
