"""Line-first quality rules, in DataFrame functions only.

Each line is judged by itself: lines that fail are taken out, and a document that loses too much of its text with them is
rejected. Two base rules on the whole text come before (too few words, too many repeated five-word windows).

The verdicts that ``judge`` gives by default are those of the SQL below. ``clean`` judges with ``whole=True``, which loses fewer
clean lines: sentence marks of all scripts count, lines of hard-wrapped prose are asked for a mark together, and noise has a
least count, without the mark of a heading or list item.

Defined results: null text counts as empty; an empty text has no words, fails the base rules and is not kept; rows are
judged one by one, so repeated rows give equal results; extra columns are not looked at; a table without rows gives none.
Nothing is shuffled, so neither a large source nor a group of copies matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import GAP, SPACES, WORD, free_name, let, word_count, words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Line rules.
SEPARATORS = r"[|»›•·]"
MIN_SEPARATORS = 3
SEPARATORS_PERCENT = 30  # of the line's words
NOISE = r"[#*$%&<>~^]+|!!+"
NOISE_PERCENT = 30  # of the line's words
SENTENCE_MARK = r"[.!?…。！？:;]"
UNMARKED_WORDS = 8  # a line of so many words needs a sentence mark somewhere
# Where ``whole``: the sentence terminals of Unicode, and marks that are used like those above.
ANY_MARK = (
    r"[.!?…:;\u055C\u055E\u0589\u061B\u061D-\u061F\u06D4\u0700-\u0702\u07F9\u0837\u0839\u083D\u083E\u0964\u0965\u0F0D\u0F0E"
    r"\u104A\u104B\u1362\u1365-\u1368\u166E\u1735\u1736\u17D4-\u17D6\u1803\u1809\u1944\u1945\u1AA8-\u1AAB\u1B5A\u1B5B\u1B5E"
    r"\u1B5F\u1C3B\u1C3C\u1C7E\u1C7F\u203C\u203D\u2047-\u2049\u2E2E\u2E3C\u2E53\u2E54\u3002\uA4FF\uA60E\uA60F\uA6F3\uA6F7"
    r"\uA876\uA877\uA8CE\uA8CF\uA92F\uA9C8\uA9C9\uAA5D-\uAA5F\uAAF0\uAAF1\uABEB\uFE52\uFE56\uFE57\uFF01\uFF0E\uFF1A\uFF1B"
    r"\uFF1F\uFF61]"
)
NO_MARKS = r"[\p{IsThai}\p{IsLao}]"  # scripts that write sentences without marks
SENTENCE_END = ANY_MARK + r"[\p{Pe}\p{Pf}\"'*_\s]*$"
GOES_ON = r"^\s*[\p{Pi}\p{Ps}\"']*[\p{Ll}\p{Lo}]"  # a line that begins so goes on with the sentence before
LEADING_MARK = r"^\s*(#{1,6}|\*)\s+"  # of a heading or a list item
MIN_NOISE = 3
# Site furniture; licence and copyright lines are part of a document and stay.
BOILERPLATE = (
    r"(?i)\b(privacy policy|cookie policy|terms of (use|service)|enable javascript|click here|sign (in|up)|log in"
    r"|subscribe (now|to)|lorem ipsum)\b"
)
BOILERPLATE_WORDS = 20  # a longer line is prose that mentions the phrase
MAX_LOST_PERCENT = 40  # of the document's words


def repeated_window_words(of_words: Column) -> Column:
    """Words covered by ``WINDOW``-word windows that the array holds twice or more, the first occurrence included.

    Hashes only tell that no window repeats; where some do, the windows themselves are sorted and compared.
    """
    last = F.size(of_words) - WINDOW

    def hashes(ws: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(ws) - WINDOW), lambda i: F.xxhash64(*[ws[i + k] for k in range(WINDOW)])
        )

    def windows(ws: Column) -> Column:
        return F.array_sort(
            F.transform(
                F.sequence(F.lit(0), F.size(ws) - WINDOW),
                lambda i: F.struct(F.array_join(F.slice(ws, i + 1, WINDOW), " ").alias("w"), i.alias("p")),
            )
        )

    def repeats(s: Column) -> Column:
        marked = F.transform(
            s,
            lambda x, j: F.when(
                F.coalesce(F.get(s, j - 1)["w"] == x["w"], F.lit(False))
                | F.coalesce(F.get(s, j + 1)["w"] == x["w"], F.lit(False)),
                x["p"],
            ),
        )
        return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))

    def covered(at: Column) -> Column:
        steps = F.transform(
            at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW))).cast("long")
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)

    def count(ws: Column) -> Column:
        return F.when(
            let(hashes(ws), lambda h: F.size(F.array_distinct(h)) < F.size(h)),
            let(let(windows(ws), repeats), covered),
        ).otherwise(F.lit(0).cast("long"))

    return F.when(last >= 1, let(of_words, count)).otherwise(F.lit(0).cast("long"))


def line_fails(line: Column, n_words: Column) -> Column:
    """Whether a line is navigation, noise, unpunctuated or boilerplate. ``n_words`` is its word count, at least 1."""
    separators = F.regexp_count(line, F.lit(SEPARATORS))
    navigation = (separators >= MIN_SEPARATORS) & (separators * 100 >= n_words * SEPARATORS_PERCENT)
    noise = F.regexp_count(line, F.lit(NOISE)) * 100 >= n_words * NOISE_PERCENT
    unmarked = (n_words >= UNMARKED_WORDS) & ~line.rlike(SENTENCE_MARK)
    boilerplate = (n_words <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE)
    return navigation | noise | unmarked | boilerplate


def whole_line_fails(line: Column, n_words: Column, marked: Column) -> Column:
    """``line_fails`` where a line is ``marked`` if the lines that its sentences stand in hold a sentence mark."""
    separators = F.regexp_count(line, F.lit(SEPARATORS))
    navigation = (separators >= MIN_SEPARATORS) & (separators * 100 >= n_words * SEPARATORS_PERCENT)
    tokens = F.regexp_count(F.regexp_replace(line, LEADING_MARK, ""), F.lit(NOISE))
    noise = (tokens >= MIN_NOISE) & (tokens * 100 >= n_words * NOISE_PERCENT)
    unmarked = (n_words >= UNMARKED_WORDS) & ~marked & ~line.rlike(NO_MARKS)
    boilerplate = (n_words <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE)
    return navigation | noise | unmarked | boilerplate


def wrapped(lines: Column) -> Column:
    """Lines grouped to arrays: a line goes on in the next one if it doesn't end a sentence and the next begins like the
    middle of one, or its first word had no room on the line (no neighbour is longer than both together)."""

    def goes_on(ls: Column, i: Column) -> Column:
        line, then = F.get(ls, i), F.get(ls, i + 1)
        first = F.regexp_extract(then, f"^[ \t]*({WORD})", 1)
        sizes = [F.coalesce(F.length(F.get(ls, i + k)), F.lit(0)) for k in (-1, 0, 1, 2)]
        full = F.length(line) + 1 + F.length(first) > F.greatest(*sizes)
        both = line.rlike(WORD) & then.rlike(WORD)
        return F.coalesce(both & ~line.rlike(SENTENCE_END) & (then.rlike(GOES_ON) | full), F.lit(False))

    def group(ls: Column) -> Column:
        # No line holds a line break, so these signs tell lines and groups apart.
        signed = F.transform(
            ls, lambda line, i: F.concat(F.when((i > 0) & goes_on(ls, i - 1), "\n+").otherwise("\n-"), line)
        )
        groups = F.split(F.substring(F.array_join(signed, ""), 3, 2**31 - 1), "\n-")
        return F.transform(groups, lambda g: F.split(g, r"\n\+"))

    return let(lines, group)


def judge(docs: DataFrame, text: str = "text", verdict: str = "quality", whole: bool = False) -> DataFrame:
    """``docs`` with one more column, the struct ``verdict``: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, lost_words (long), base_failed, kept (boolean) and clean_text (the lines that passed). Name it otherwise
    if ``docs`` has a column of that name (``free_name``). ``whole``: by the rules that lose fewer clean lines."""
    body = F.coalesce(F.col("_body"), F.lit(""))
    squeezed = F.col("_body")
    for space in SPACES:
        squeezed = F.replace(squeezed, F.lit(space), F.lit(""))

    def one_line(line: Column) -> Column:
        n = word_count(line)
        return let(
            n, lambda k: F.struct(line.alias("l"), k.alias("n"), F.when(k > 0, line_fails(line, k)).otherwise(False).alias("f"))
        )

    def one_group(lines: Column) -> Column:
        marked = F.exists(lines, lambda x: x.rlike(ANY_MARK))
        return let(marked, lambda m: F.transform(lines, lambda line: whole_line(line, m)))

    def whole_line(line: Column, marked: Column) -> Column:
        fails = lambda k: F.when(k > 0, whole_line_fails(line, k, marked)).otherwise(False)
        return let(word_count(line), lambda k: F.struct(line.alias("l"), k.alias("n"), fails(k).alias("f")))

    def lines_whole(lines: Column) -> Column:
        # Which lines go on only matters where a line of its own lacks the mark it needs.
        lacking = F.exists(
            lines, lambda x: ~x.rlike(ANY_MARK) & (word_count(x) >= UNMARKED_WORDS) & ~x.rlike(NO_MARKS)
        )
        alone = F.transform(lines, lambda x: whole_line(x, x.rlike(ANY_MARK)))
        return F.when(lacking, F.flatten(F.transform(wrapped(lines), one_group))).otherwise(alone)

    parts = F.split("_body", "\n")
    judged_lines = let(parts, lines_whole) if whole else F.transform(parts, one_line)
    packed = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_body"))
    split = packed.select(
        "_row",
        "_body",
        words(F.col("_body")).alias("_words"),
        judged_lines.alias("_lines"),
    )
    spoken = F.transform(F.filter("_lines", lambda x: x["n"] > 0), lambda x: x["l"])
    measured = split.select(
        "_row",
        F.size("_words").cast("long").alias("n_words"),
        F.length(squeezed).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(spoken, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("_words")).alias("n_repeat_words"),
        F.aggregate(
            "_lines", F.lit(0).cast("long"), lambda total, x: total + F.when(x["f"], x["n"]).otherwise(F.lit(0))
        ).alias("lost_words"),
        F.array_join(F.transform(F.filter("_lines", lambda x: ~x["f"]), lambda x: x["l"]), "\n").alias("clean_text"),
    )
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    decided = measured.withColumn("base_failed", base).withColumn(
        "kept", ~base & (F.col("lost_words") * 100 <= F.col("n_words") * MAX_LOST_PERCENT)
    )
    fields = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words", "base_failed", "kept", "clean_text",
    ]
    return decided.select("_row", F.struct(*fields).alias("_verdict")).select("_row.*", F.col("_verdict").alias(verdict))


def clean(docs: DataFrame, text: str = "text", chars: str | None = "n_chars") -> DataFrame:
    """The documents that are kept, with their columns as they were, without the lines that failed.

    ``chars`` names the column with the number of characters of the text, which is set anew where lines went; None: no
    such column.
    """
    name = free_name(docs, "quality")
    judged = judge(docs, text, name, whole=True).where(F.col(f"{name}.kept"))
    cut, shorter = F.col(f"{name}.lost_words") > 0, F.col(f"{name}.clean_text")
    changed = {text: F.when(cut, shorter).otherwise(F.col(text))}
    if chars is not None and chars in docs.columns:
        changed[chars] = F.when(cut, F.length(shorter).cast(docs.schema[chars].dataType)).otherwise(F.col(chars))
    return judged.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])


# The same rules for another SQL engine, over the table documents.
SQL = f"""
WITH body AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
ws AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{GAP}'), lambda w: w <> '') AS w FROM body),
grams AS (
  SELECT rid, i, list_aggregate(w[i:i + {WINDOW - 1}], 'string_agg', ' ') AS g
  FROM (SELECT row_number() OVER () AS rid, doc_id, t, w FROM ws), unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1))) AS u(i)),
hits AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
cover AS (
  SELECT rid, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM hits) GROUP BY rid),
lines AS (
  SELECT rid, l, len(regexp_extract_all(l, '{WORD}')) AS n
  FROM (SELECT row_number() OVER () AS rid, doc_id, t, w FROM ws), unnest(string_split(t, chr(10))) AS u(l)),
judged AS (
  SELECT rid, l, n,
         (len(regexp_extract_all(l, '{SEPARATORS}')) >= {MIN_SEPARATORS}
            AND len(regexp_extract_all(l, '{SEPARATORS}')) * 100 >= n * {SEPARATORS_PERCENT})
         OR len(regexp_extract_all(l, '{NOISE}')) * 100 >= n * {NOISE_PERCENT}
         OR (n >= {UNMARKED_WORDS} AND NOT regexp_matches(l, '{SENTENCE_MARK}'))
         OR (n <= {BOILERPLATE_WORDS} AND regexp_matches(l, '{BOILERPLATE}')) AS f
  FROM lines WHERE n > 0),
per AS (
  SELECT rid, count(*) - count(DISTINCT l) AS dups, coalesce(sum(n) FILTER (WHERE f), 0)::BIGINT AS lost FROM judged GROUP BY rid),
base AS (
  SELECT a.doc_id, len(a.w)::BIGINT AS n_words,
         length(regexp_replace(a.t, '{GAP}', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(a.t, '{SYMBOLS}'))::BIGINT AS n_symbols,
         coalesce(p.dups, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(p.lost, 0)::BIGINT AS lost_words
  FROM (SELECT row_number() OVER () AS rid, doc_id, t, w FROM ws) a LEFT JOIN per p USING (rid) LEFT JOIN cover c USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
         AND lost_words * 100 <= n_words * {MAX_LOST_PERCENT} AS kept
FROM base
"""
