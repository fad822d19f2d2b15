"""Quality rules that clean line by line first and judge the document by what is left.

Every line with a word is held against three rules. *Punctuation*: prose ends in a closing mark
and is not strewn with marks and symbols. *Navigation*: a list of links is cut by separators, or
is one short menu entry. *Boilerplate*: legal and site notices, a line the text has had before,
one word over and over. Lines that fail are removed; a document that loses too much of its text
is rejected. All of it is column expressions on one row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the digest: white space, symbols, length of a repeated window and the limits.
WHITE = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
FEWEST_WORDS = 20
MOST_REPEATED_PERCENT = 30

MOST_LOST_PERCENT = 50
RULES = ("navigation", "boilerplate", "punctuation")
NOISE_PER_WORDS = 5  # one mark of noise for every so many words is too much
LINKS_PER_WORDS = 4  # one separator for every so many words makes a list of links
# A closing mark (also an ellipsis, and those of Chinese, Hindi, Arabic and Urdu), before quotes and brackets.
ENDS = ".!?:;\u2026\u3002\uff01\uff1f\u0964\u061f\u06d4"
CLOSERS = "\"'\u201d\u2019\u00bb)]"
NOISES = ("!!", "!?", "?!", "??", "#", "*", "$", "%", "&", "<", ">")
NOISE = r"[!?]{2,}|[#*$%&<>]+"
SEPARATORS = "|\u00bb\u203a\u2022\u00b7\u2192"
MENU = (
    r"(?i)^[^a-z0-9]*(home|menu|log ?in|log ?out|sign (in|up)|register|search|next|previous|back to top|read more|share|"
    r"contact( us)?|about( us)?|skip to (main )?content|site ?map)[^a-z0-9]*\z"
)
NOTICE = (
    r"(?i)(cookie (policy|settings|consent)|(uses?|accept( all)?) cookies|privacy policy|terms of (use|service)|all rights reserved|"
    r"\x{00A9}|\(c\) [0-9]{4}|enable javascript|lorem ipsum|subscribe to our|click here|powered by)"
)
# Every match of NOTICE holds one of these.
NOTICES = (
    "cookie", "privacy policy", "terms of", "all rights reserved", "\u00a9", "(c) ", "enable javascript", "lorem ipsum",
    "subscribe to our", "click here", "powered by",
)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body (or a function of array
    elements in it) names it. A plain column could be put in its place each time."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def _visible(words: Column) -> Column:
    """How many characters words have."""
    return F.aggregate(words, F.lit(0).cast("long"), lambda total, w: total + F.length(w))


def _windows(size: Column, at: Callable[[Column], Column]) -> Column:
    return F.transform(F.sequence(F.lit(0), size - WINDOW), at)


def _covered(starts: Column) -> Column:
    """Places covered by windows that start at these, in ascending order."""
    steps = lambda s: F.transform(s, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - p, F.lit(WINDOW))))
    return bound(starts, lambda s: F.aggregate(steps(s), F.lit(0), lambda total, x: total + x)).cast("long")


def _repeated_starts(words: Column, hashes: Column) -> Column:
    """Starts of the windows found twice or more, told apart by 96 bits, in ascending order."""
    second = lambda p: F.hash(*(F.get(words, p + k) for k in range(WINDOW)))
    marked = F.sort_array(F.transform(hashes, lambda h, p: F.struct(h.alias("h"), second(p).alias("g"), p.alias("p"))))
    same = lambda x, y: F.coalesce((x["h"] == y["h"]) & (x["g"] == y["g"]), F.lit(False))
    again = lambda m: F.filter(m, lambda x, k: same(x, F.get(m, k - 1)) | same(x, F.get(m, k + 1)))
    return F.sort_array(F.transform(bound(marked, again), lambda x: x["p"]))


def repeated_words(words: Column) -> Column:
    """How many words lie in windows of eight words that the text has twice or more."""
    window = lambda codes: _windows(F.size(words), lambda p: F.xxhash64(*(F.get(codes, p + k) for k in range(WINDOW))))
    hashes = bound(F.transform(words, lambda w: F.xxhash64(w)), window)
    found = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(_repeated_starts(words, h)))
    return F.coalesce(F.when(F.size(words) >= WINDOW, bound(hashes, found)), F.lit(0).cast("long"))


def _ordered_lines(text: Column) -> Column:
    """The lines in the order of their wording, each with its place and whether one before is equal."""
    marked = F.sort_array(F.transform(F.split(text, "\n"), lambda line, p: F.struct(line.alias("line"), p.alias("p"))))
    seen = lambda m, x, k: F.coalesce(F.get(m, k - 1)["line"] == x["line"], F.lit(False))
    return bound(marked, lambda m: F.transform(m, lambda x, k: F.struct(x["p"].alias("p"), x["line"].alias("line"), seen(m, x, k).alias("seen"))))


def _holds_any(text: Column, parts) -> Column:
    return reduce(Column.__or__, (F.contains(text, F.lit(p)) for p in parts))


def _hints(text: Column) -> Column:
    """What a whole text has at all, by plain search, so that most lines need no pattern."""
    return F.struct(
        _holds_any(F.lower(text), NOTICES).alias("notices"),
        _holds_any(text, SEPARATORS).alias("links"),
        _holds_any(text, NOISES).alias("noise"),
    )


def _ended(line: Column) -> Column:
    """Whether a line ends in a closing mark, quotes and brackets after it aside."""
    return F.right(F.rtrim(F.rtrim(line, F.lit(WHITE)), F.lit(CLOSERS)), F.lit(1)).isin(*ENDS)


def _failed(line: Column, seen: Column, words: Column, hints: Column) -> Column:
    """Name of the first rule a line breaks, null for none and for lines without a word."""
    n = F.size(words)
    noise = F.regexp_count(line, F.lit(NOISE)) * NOISE_PER_WORDS > n
    links = F.regexp_count(line, F.lit(f"[{SEPARATORS}]"))
    same = F.size(F.filter(words, lambda w, k: F.coalesce(w == F.get(words, k - 1), F.lit(False))))
    listed = hints["links"] & bound(links, lambda x: (x >= 2) & (x * LINKS_PER_WORDS >= n))
    return (
        F.when(n == 0, F.lit(None).cast("string"))
        .when(listed | line.rlike(MENU), "navigation")
        .when(seen | (hints["notices"] & line.rlike(NOTICE)) | ((n >= 4) & (2 * same > n)), "boilerplate")
        .when(~_ended(line) | (hints["noise"] & noise), "punctuation")
    )


def _judged_lines(text: Column) -> Column:
    judged = lambda x, hints: bound(
        words_of(x["line"]),
        lambda w: F.struct(
            x["p"].alias("p"), x["line"].alias("line"), w.alias("words"),
            x["seen"].alias("seen"), _failed(x["line"], x["seen"], w, hints).alias("failed"),
        ),
    )
    lines = _ordered_lines(text)
    return F.sort_array(bound(_hints(text), lambda hints: F.transform(lines, lambda x: judged(x, hints))))


def _words(lines: Column) -> Column:
    """The words of the whole text, as no word goes over a line's end."""
    return F.flatten(F.transform(lines, lambda x: x["words"]))


def _count(rows: Column, condition: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(rows, condition)).cast("long")


def _report(text: Column, words: Column, lines: Column) -> Column:
    """Line figures, base figures and the cleaned text of one document."""
    lost = F.aggregate(F.filter(lines, lambda x: x["failed"].isNotNull()), F.lit(0).cast("long"), lambda a, x: a + _visible(x["words"]))
    left = F.transform(F.filter(lines, lambda x: x["failed"].isNull()), lambda x: x["line"])
    failing = lambda rule: _count(lines, lambda x: x["failed"] == rule)
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        _visible(words).alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        _count(lines, lambda x: (F.size(x["words"]) > 0) & x["seen"]).alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
        *(failing(rule).alias(f"n_{rule}") for rule in RULES),
        lost.alias("lost_chars"),
        F.array_join(left, "\n").alias("clean_text"),
    )


def judged(text: Column) -> Column:
    """All figures of a text, ``base_failed``, ``kept`` and ``clean_text`` as one struct; null counts as empty."""
    report = bound(
        F.coalesce(text, F.lit("")),
        lambda t: bound(_judged_lines(t), lambda lines: bound(_words(lines), lambda w: _report(t, w, lines))),
    )

    def verdict(r: Column) -> Column:
        base = (r["n_words"] < FEWEST_WORDS) | (100 * r["n_repeat_words"] > MOST_REPEATED_PERCENT * r["n_words"])
        enough = 100 * r["lost_chars"] <= MOST_LOST_PERCENT * r["word_chars"]
        return r.withField("base_failed", base).withField("kept", ~base & enough)

    return bound(report, verdict)


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, the figures of each document, base_failed, kept and clean_text.

    n_words, word_chars (characters in words), n_symbols, n_dup_lines (lines equal to an earlier one),
    n_repeat_words, n_navigation, n_boilerplate and n_punctuation (lines removed by each rule),
    lost_chars (characters in words of the lines removed). A null or empty text has no words and fails. Repeated rows are
    judged one by one, a null id is carried along, other columns are not read, an empty table gives
    no row. Windows within one text are told apart by 96 bits.
    """
    return docs.select("doc_id", judged(F.col("text")).alias("report")).select("doc_id", "report.*")


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns, ``text`` without the lines that failed."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), judged(F.col("text")).alias("report")).where("report.kept")
    columns = [F.col("report.clean_text").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    return rows.select(*columns)
