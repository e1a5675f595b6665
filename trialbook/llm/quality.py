"""Quality rules, lines first.

Every line is judged alone: whether a word of it ends in a sentence mark and how much of it is
decoration (punctuation), whether it
is a row of links or cells (navigation), whether it is a stock phrase or a repetition of an earlier
line (boilerplate). Lines that fail are removed, and a document is rejected when it loses more than
``most_lost`` of its word characters, or when the whole text fails the base rules.

Sentence marks of all scripts count, and lines mostly in a script without such marks (Thai, Lao) need none. The
SQL twin knows the Latin marks only, so ``kept`` may differ from it on texts in other scripts. Words are what blanks
separate, as in the twin, so texts without blanks have few and fail the base rules.

All figures come from expressions on one row; there is no shuffle. A null text has no words and
fails the base rules. Other columns, of any name, are ignored or passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialbook.llm import query
from trialbook.llm.text import WORD, let, table, whole, words

# Symbols of the contract, and the patterns of a line that fails. They are read
# alike by Java's and RE2's expressions.
SYMBOLS = r"[#*$%&|<>]"
MARK = r"""[.,!?…:;"'”’»)\]]([\x20\x09-\x0D]|$)"""
DECORATED = r"[!?#*$%&|<>@~^=_+]{2,}[^\x20\x09-\x0D]*"  # from the marks to the end of the word: one match a word
# Marks of other scripts than the Latin one, which count wherever they stand, since not all scripts set blanks after them:
# Unicode's terminal punctuation without the Ethiopic word space and double marks like U+203C, Armenian tone marks, and closing quotes and brackets.
OTHER_MARKS = (
    r"["
    r"\x{37E}\x{387}\x{55B}-\x{55E}\x{589}\x{5C3}\x{60C}\x{61B}\x{61D}-\x{61F}\x{6D4}\x{700}-\x{70A}\x{70C}\x{7F8}-\x{7F9}"
    r"\x{830}-\x{835}\x{837}-\x{83E}\x{85E}\x{964}-\x{965}\x{E5A}-\x{E5B}\x{F08}\x{F0D}-\x{F12}\x{104A}-\x{104B}"
    r"\x{1362}-\x{1368}\x{166E}\x{16EB}-\x{16ED}\x{1735}-\x{1736}\x{17D4}-\x{17D6}\x{17DA}\x{1802}-\x{1805}\x{1808}-\x{1809}"
    r"\x{1944}-\x{1945}\x{1AA8}-\x{1AAB}\x{1B4E}-\x{1B4F}\x{1B5A}-\x{1B5B}\x{1B5D}-\x{1B5F}\x{1B7D}-\x{1B7F}\x{1C3B}-\x{1C3F}"
    r"\x{1C7E}-\x{1C7F}\x{2CF9}-\x{2CFB}\x{2E2E}\x{2E3C}\x{2E41}\x{2E4C}\x{2E4E}-\x{2E4F}"
    r"\x{2E53}-\x{2E54}\x{2E60}-\x{2E61}\x{3001}-\x{3002}\x{3009}\x{300B}\x{300D}\x{300F}\x{3011}\x{3015}\x{3017}\x{3019}"
    r"\x{301B}\x{A4FE}-\x{A4FF}\x{A60D}-\x{A60F}\x{A6F3}-\x{A6F7}\x{A876}-\x{A877}\x{A8CE}-\x{A8CF}\x{A92F}\x{A9C7}-\x{A9C9}"
    r"\x{AA5D}-\x{AA5F}\x{AADF}\x{AAF0}-\x{AAF1}\x{ABEB}\x{FE12}\x{FE15}-\x{FE16}\x{FE42}\x{FE44}\x{FE50}-\x{FE52}"
    r"\x{FE54}-\x{FE57}\x{FF01}\x{FF09}\x{FF0C}\x{FF0E}\x{FF1A}-\x{FF1B}\x{FF1F}\x{FF3D}\x{FF61}\x{FF63}-\x{FF64}\x{1039F}"
    r"\x{103D0}\x{10857}\x{1091F}\x{10A56}-\x{10A57}\x{10AF0}-\x{10AF5}\x{10B3A}-\x{10B3F}\x{10B99}-\x{10B9C}"
    r"\x{10F55}-\x{10F59}\x{10F86}-\x{10F89}\x{11047}-\x{1104D}\x{110BE}-\x{110C1}\x{11141}-\x{11143}\x{111C5}-\x{111C6}"
    r"\x{111CD}\x{111DE}-\x{111DF}\x{11238}-\x{1123C}\x{112A9}\x{113D4}-\x{113D5}\x{1144B}-\x{1144D}\x{1145A}-\x{1145B}"
    r"\x{115C2}-\x{115C5}\x{115C9}-\x{115D7}\x{11641}-\x{11642}\x{1173C}-\x{1173E}\x{11944}\x{11946}\x{11A42}-\x{11A43}"
    r"\x{11A9B}-\x{11A9C}\x{11AA1}-\x{11AA2}\x{11C41}-\x{11C43}\x{11C71}\x{11EF7}-\x{11EF8}\x{11F43}-\x{11F44}"
    r"\x{12470}-\x{12474}\x{16A6E}-\x{16A6F}\x{16AF5}\x{16B37}-\x{16B39}\x{16B44}\x{16D6E}-\x{16D6F}\x{16E97}-\x{16E98}"
    r"\x{1BC9F}\x{1DA87}-\x{1DA8A}"
    r"]"
)
UNMARKED = r"[\x{E00}-\x{EFF}\x{1950}-\x{19DF}\x{AA80}-\x{AADF}]"  # Thai, Lao and Tai scripts, whose prose has no marks
SEPARATORS = r"[|›»•·→]"
BOILERPLATE = (
    r"(?i)(all rights reserved|licensed under|released under the|terms of (use|service)|privacy policy|cookie|javascript|"
    r"copyright|©|sign (in|up)|log in|subscribe|newsletter|click here|read more|share this|follow us|skip to content|lorem ipsum)"
)
SHORT_LINE = 30  # words; a longer line is not boilerplate for a phrase in it


def repeat_words(w: Column) -> Column:
    """Words of the array that lie in a three-word window found twice or more.

    The windows are sorted by hash with their places, so equal ones are neighbours, which their words
    confirm; each place found covers the words up to the next place, three at most.
    """
    n = F.size(w)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")))

    def alike(x: Column, y: Column) -> Column:
        return (x["h"] == y["h"]) & (w[x["i"]] == w[y["i"]]) & (w[x["i"] + 1] == w[y["i"] + 1]) & (w[x["i"] + 2] == w[y["i"] + 2])

    def places(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: alike(x, F.get(s, j - 1)) | alike(x, F.get(s, j + 1)))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)

    return F.when(n < 3, F.lit(0).cast("long")).otherwise(let(let(F.sort_array(windows), places), covered))


def line_passes(line: Column) -> Column:
    """Whether a line with a word passes the rules of one line."""
    n = F.size(words(line))
    decorated = F.size(F.regexp_extract_all(line, F.lit(DECORATED), F.lit(0)))
    separators = F.length(line) - F.length(F.regexp_replace(line, SEPARATORS, ""))
    # The later ones are worked out for lines that the earlier ones do not pass.
    unmarked = F.length(F.regexp_replace(line, UNMARKED, "")) * 2 < F.length(line)
    punctuation = (line.rlike(MARK) | line.rlike(OTHER_MARKS) | unmarked) & (decorated * 2 <= n)
    navigation = (separators >= 3) & (separators * 6 >= n)
    boilerplate = (n <= SHORT_LINE) & line.rlike(BOILERPLATE)
    return punctuation & ~navigation & ~boilerplate


def quality(
    docs: DataFrame, text: str = "text", least_words: int = 50, most_repeated: float = 0.5, most_lost: float = 0.5, prefix: str = "",
) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, clean_text,
    lost_chars and kept, each under ``prefix``."""
    t = whole(text)
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    parts = docs.withColumns({"__words": words(t), "__lines": lines})

    def chars(c: Column) -> Column:
        return F.length(F.regexp_replace(c, r"[\x20\x09-\x0D]+", ""))

    parts = parts.withColumns({
        "__distinct": F.array_distinct("__lines"), "__n_words": F.size("__words").cast("long"),
        "__word_chars": F.length(F.array_join("__words", "")).cast("long"), "__repeat": repeat_words(F.col("__words"))})
    # A repetition of an earlier line is boilerplate too: only first lines are left to judge.
    parts = parts.withColumn("__passed", F.array_join(F.filter("__distinct", line_passes), "\n"))
    lost = F.col("__word_chars") - chars(F.col("__passed"))
    failed = (F.col("__n_words") < least_words) | (F.col("__repeat") > F.lit(most_repeated) * F.col("__n_words"))
    out = {
        "n_words": F.col("__n_words"),
        "word_chars": F.col("__word_chars"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS + "+", ""))).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size("__distinct")).cast("long"),
        "n_repeat_words": F.col("__repeat"),
        "base_failed": failed,
        "clean_text": F.col("__passed"),
        "lost_chars": lost.cast("long"),
        "kept": ~failed & (lost <= F.lit(most_lost) * F.col("__word_chars")),
    }
    # The figures pass through a generator of one row, below which no filter on them is pushed: pushed down,
    # it would work out every expression it uses once more for itself.
    figures = F.inline(F.array(F.struct(*[v.alias(prefix + k) for k, v in out.items()])))
    return parts.select(*[c for c in docs.columns if c not in {prefix + k for k in out}], figures)


def accepted(docs: DataFrame, text: str = "text", **rules) -> DataFrame:
    """The rows of ``docs`` that are kept, as they were."""
    return quality(docs, text, prefix="__q_", **rules).filter("__q_kept").select(*docs.columns)


def _sql() -> str:
    def q(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    word = q(WORD)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {word}) AS w FROM documents),
grams AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, x FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, {word})),
firsts AS (SELECT doc_id, x, count(*) AS n FROM lines GROUP BY doc_id, x),
judged AS (SELECT doc_id, n, len(regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars, len(regexp_extract_all(x, {word})) AS nw,
  len(regexp_extract_all(x, {q(DECORATED)})) AS deco, len(x) - len(regexp_replace(x, {q(SEPARATORS)}, '', 'g')) AS seps,
  regexp_matches(x, {q(MARK)}) OR regexp_matches(x, {q(OTHER_MARKS)}) OR len(regexp_replace(x, {q(UNMARKED)}, '', 'g')) * 2 < len(x) AS ends, regexp_matches(x, {q(BOILERPLATE)}) AS boiler FROM firsts),
by_doc AS (SELECT doc_id, sum(n) - count(*) AS n_dup_lines,
  coalesce(sum(chars) FILTER (ends AND deco * 2 <= nw AND NOT (seps >= 3 AND seps * 6 >= nw) AND NOT (nw <= {SHORT_LINE} AND boiler)), 0) AS passed FROM judged GROUP BY doc_id),
base AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(t) - len(regexp_replace(t, {q(SYMBOLS)}, '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(passed, 0) AS passed
  FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN by_doc USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND (word_chars - passed) * 2 <= word_chars AS kept FROM base"""


@query("op8_quality_rules", sql=_sql())
def _(spark, folder):
    return quality(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
