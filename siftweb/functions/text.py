"""Text functions: letter profiles, language guess, result snippets
(D5, D6, Q18-Q20), all as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftweb.functions.html import WS_CLASS, strip_ws
from siftweb.functions.urls import _let

# The 30 counted letters and the two reference letter
# profiles (percent, A-Z then ß Ä Ö Ü).
LETTERS = list("ABCDEFGHIJKLMNOPQRSTUVWXYZ") + ["ß", "Ä", "Ö", "Ü"]
PROFILES = {
    "de": [6.51, 1.89, 3.06, 5.08, 17.4, 1.66, 3.01, 4.76, 7.55, 0.27, 1.21, 3.44, 2.53,
           9.78, 2.51, 0.79, 0.02, 7.00, 7.27, 6.15, 4.35, 0.67, 1.89, 0.03, 0.04, 1.13,
           0.31, 0.54, 0.3, 0.65],
    "en": [8.167, 1.492, 2.782, 4.253, 12.702, 2.228, 2.015, 6.094, 6.966, 0.153, 0.772,
           4.025, 2.406, 6.749, 7.507, 1.929, 0.095, 5.987, 6.327, 9.056, 2.758, 0.978,
           2.361, 0.150, 1.974, 0.074, 0, 0, 0, 0],
}

SNIPPET_DELTA = 40


_COUNTED_RE = "[^" + "".join(LETTERS) + "]"


def letter_shares(text: Column) -> list[Column]:
    """Share of each letter in the upper-cased text (count / length).

    ``upper`` turns 'ß' into 'SS', so the 'ß' share is always 0, as in the
    original.  Empty text gives nulls (no division by zero).  Stand-alone
    form; ``with_letter_shares`` is the staged, faster form for tables.
    """
    up = F.upper(text)
    total = F.length(up)
    return [
        F.when(total > 0, (total - F.length(F.replace(up, F.lit(ch), F.lit("")))) / total)
        for ch in LETTERS
    ]


def with_letter_shares(df: DataFrame, text: str, prefix: str = "share_") -> DataFrame:
    """D5 over a table, in three narrow projections: upper-case once and
    keep only the counted letters (one regex pass), then count each letter
    on that short string, then divide by the full length."""
    staged = df.withColumn("_up", F.upper(F.col(text))).select(
        "*", F.length("_up").alias("_len"),
        F.regexp_replace("_up", _COUNTED_RE, "").alias("_letters")).drop("_up")
    counts = [(F.length("_letters") - F.length(F.replace(F.col("_letters"), F.lit(ch), F.lit(""))))
              .alias(f"_n{i}") for i, ch in enumerate(LETTERS)]
    staged = staged.select("*", *counts).drop("_letters")
    shares = [F.when(F.col("_len") > 0, F.col(f"_n{i}") / F.col("_len")).alias(f"{prefix}{i:02d}")
              for i in range(len(LETTERS))]
    return staged.select("*", *shares).drop("_len", *[f"_n{i}" for i in range(len(LETTERS))])


def _distance(shares: list[Column], prof: list[float]) -> Column:
    total = None
    for s, v in zip(shares, prof):
        d = s - F.lit(v / 100.0)
        total = d * d if total is None else total + d * d
    return F.sqrt(total)


def _closest(shares: list[Column], has_text: Column) -> Column:
    dists = [F.struct(_distance(shares, prof).alias("d"), F.lit(i).alias("o"), F.lit(lang).alias("lang"))
             for i, (lang, prof) in enumerate(PROFILES.items())]
    return F.when(has_text, F.array_min(F.array(*dists))["lang"])


def guess_language(text: Column) -> Column:
    """The profile with the least L2 distance ('de' wins a tie).
    Stand-alone form; ``with_language_guess`` is the staged form."""
    return _closest(letter_shares(text), F.length(text) > 0)


def with_language_guess(df: DataFrame, text: str, out: str = "guess") -> DataFrame:
    """D6 over a table: staged letter shares, then the nearest profile."""
    staged = with_letter_shares(df, text, "_s")
    shares = [F.col(f"_s{i:02d}") for i in range(len(LETTERS))]
    return staged.withColumn(out, _closest(shares, F.length(F.col(text)) > 0)) \
        .drop(*[f"_s{i:02d}" for i in range(len(LETTERS))])


def squeeze_ws(stripped: Column) -> Column:
    """Collapse the whitespace runs of a stripped text to one space (a run that
    is one already matches nothing, other ASCII is passed by one comparison)."""
    return F.regexp_replace(stripped, f"(?![!-~])(?: {WS_CLASS}+|(?! ){WS_CLASS}+)", " ")


def nice_lines(content: Column) -> Column:
    """Q18: squeeze whitespace in each line; a one-word line (after the
    first) is appended to the previous line.

    Each line is stripped once, and a line's one-word followers are cut out
    of the array together: linear in the lines."""
    def opens(word: Column, i: Column) -> Column:
        return (i == 0) | F.coalesce(word.contains(" "), F.lit(True))

    def grouped(words: Column) -> Column:
        starts = F.array_compact(F.transform(words, lambda w, i: F.when(opens(w, i), i)))
        parts = F.transform(words, lambda w, i: F.when(opens(w, i), squeeze_ws(w)).otherwise(w))
        return _let(F.struct(starts.alias("starts"), parts.alias("parts")), lambda x: F.transform(
            x["starts"], lambda start, j: line(x["parts"], start, F.coalesce(F.get(x["starts"], j + 1), F.size(x["parts"])))))

    def line(parts: Column, start: Column, end: Column) -> Column:
        whole = F.array_join(F.slice(parts, start + 1, end - start), " ")
        return F.when(F.get(parts, start).isNotNull(), whole)      # a null line stays one

    empty = F.array().cast("array<string>")
    return _let(F.transform(F.coalesce(content, empty), strip_ws), grouped)


def snippet(lines: Column, keywords: Column, delta: int = SNIPPET_DELTA) -> Column:
    """Q19/Q20: text around the first keyword found (in keyword order).

    ``delta`` characters either side, '...' in front when cut on the left.
    No keyword in the text: the second line if any, else ''.  Lines, text
    and place are bound once, however often they are used.
    """
    def around(text: Column, first: Column) -> Column:             # 1-based position
        start0 = F.greatest(first - 1 - delta, F.lit(0))
        end0 = F.least(F.length(text), first - 1 + delta)
        cut = F.substring(text, start0 + 1, end0 - start0)
        return F.concat(F.when(start0 > 0, F.lit("...")).otherwise(F.lit("")), cut)

    def first_found(low: Column) -> Column:
        positions = F.transform(keywords, lambda k: F.position(F.lower(k), low))
        return F.get(F.filter(positions, lambda pos: pos > 0), F.lit(0))

    def of(lines: Column, text: Column) -> Column:
        fallback = F.when(F.size(lines) > 1, F.element_at(lines, 2)).otherwise(F.lit(""))
        return _let(_let(F.lower(text), first_found), lambda first: (
            F.when(F.length(text) == 0, F.lit(""))
            .when(first.isNotNull(), around(text, first))
            .otherwise(fallback)))

    return _let(lines, lambda ls: _let(F.array_join(ls, " "), lambda text: of(ls, text)))
