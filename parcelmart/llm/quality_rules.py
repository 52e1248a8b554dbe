"""Quality rules that clean line by line first and judge the document by what is left.

Each line is held against punctuation, navigation and boilerplate rules, failing lines are removed, and a document that
loses too much of its text is rejected. Beside the verdict come the plain counts of a document-level rule set.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from parcelmart.llm.common import ROW_BYTES, table, text_batches

# What counts as a symbol, and the limits of the document-level rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 10
WINDOW = 5
MOST_REPEATED = 20  # percent of words

# Line rules.
LEAST_RULED_WORDS = 4  # shorter lines are only held against boilerplate and repetition
SYMBOLS_PER_WORD = 0.5
SHOUTED_SHARE = 0.5
BARE_WORDS = 60  # a line of so many words without any mark is not prose
# Lines without any mark, so many in a row or more (blank lines aside), are a menu or a bare list unless a line that ends
# in a colon leads them in. A line of few words and many letters may be of a script without spaces or marks.
LEAST_RUN = 3
ENTRY_CHARS = 40
COLONS = (":", "：")
NAVIGATION_WORDS = frozenset(
    "home about contact news shop login logout register account cart search help faq blog archive sitemap support products "
    "services privacy terms careers jobs press events gallery forum download downloads imprint menu us sign in up".split()
)
MARKS = re.compile(r"[.,;:!?…。，、！？؟।]")
SEPARATORS = frozenset("|/»›>•·→")
SEPARATOR_SHARE = 0.2
SAME_WORD_SHARE = 0.5
ECHO_SHARE = 0.4
BOILERPLATE_WORDS = 30
BOILERPLATE = re.compile(
    r"(accept (all )?cookies|cookie policy|use of cookies|we use cookies|privacy policy|terms of (use|service)"
    r"|all rights reserved|enable javascript|javascript is disabled|sign up for our newsletter|subscribe to our"
    r"|share (this )?on (facebook|twitter)|skip to (main )?content|click here to|lorem ipsum)",
    re.IGNORECASE,
)
# A document that loses more of its word characters than this is rejected.
MOST_LOST = 0.5
VERDICTS = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, n_lines bigint, n_removed_lines bigint, lost_chars bigint"
)
SPACE = " \t\n\r\x0b\x0c"
_DROP_SYMBOLS = str.maketrans("", "", SYMBOLS)


def repeated_words(words: list) -> int:
    """Number of words inside windows of five that occur at least twice; windows are compared exactly."""
    n = len(words)
    if n <= WINDOW:
        return 0
    rank = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(rank.__getitem__, words), np.int64, n)
    codes, base = ids[: n - WINDOW + 1], len(rank)
    bound = base
    for k in range(1, WINDOW):
        if bound > (1 << 62) // base:  # renumber before the code would overflow
            codes = np.unique(codes, return_inverse=True)[1]
            bound = int(codes.max()) + 1
        codes = codes * base + ids[k : n - WINDOW + 1 + k]
        bound *= base
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(len(codes), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def line_failure(line: str) -> str | None:
    """Name of the first rule a line breaks, None if it may stay. A line without words stays."""
    words = line.split()
    n = len(words)
    if not n:
        return None
    if n <= BOILERPLATE_WORDS and BOILERPLATE.search(line):
        return "boilerplate"
    if n >= LEAST_WORDS and Counter(words).most_common(1)[0][1] > SAME_WORD_SHARE * n:
        return "repetition"
    if n >= LEAST_RULED_WORDS and sum(map(str.__eq__, words, words[1:])) >= ECHO_SHARE * n:
        return "echo"
    if n < LEAST_RULED_WORDS:
        return None
    if sum(map(SEPARATORS.__contains__, words)) >= max(2, SEPARATOR_SHARE * n):
        return "navigation"
    if n < BARE_WORDS and 2 * sum(w in NAVIGATION_WORDS for w in map(str.lower, words)) >= max(6, n) and not MARKS.search(line):
        return "navigation"
    if len(line) - len(line.translate(_DROP_SYMBOLS)) >= SYMBOLS_PER_WORD * n:
        return "symbols"
    if line.count("!!") >= SHOUTED_SHARE * n:
        return "shouting"
    if n >= BARE_WORDS and not MARKS.search(line):
        return "no marks"
    return None


def is_bare(line: str) -> bool:
    """Whether a line with words could be an entry of a menu or bare list: no mark, and no number at its start if short."""
    if MARKS.search(line):
        return False
    words = line.split()
    if len(words) < LEAST_RULED_WORDS:
        return bool(words) and len(line) <= ENTRY_CHARS and not words[0][0].isdigit()
    return True


def bare_runs(lines: list[str]) -> set[int]:
    """Places of the lines in runs of bare ones."""
    found: set[int] = set()
    run: list[int] = []
    led = leads = False
    for i, line in enumerate([*lines, "."]):
        if not line.strip(SPACE):
            continue
        if is_bare(line):
            if not run:
                led = leads
            run.append(i)
            continue
        if len(run) >= LEAST_RUN and not led:
            found.update(run)
        run = []
        leads = line.rstrip().endswith(COLONS)
    return found


def clean_lines(text: str) -> tuple[list[str], int]:
    """Lines that stay, and the number removed; a line with words that equals an earlier one is removed too."""
    kept, seen, removed = [], set(), 0
    lines = text.split("\n")
    bare = bare_runs(lines)
    for i, line in enumerate(lines):
        if line in seen or i in bare or line_failure(line):
            removed += 1
            continue
        kept.append(line)
        if line.strip(SPACE):
            seen.add(line)
    return kept, removed


def word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, SPACE))


def examine(text: str) -> tuple[tuple, list[str]]:
    """Counts and verdict in the order of ``VERDICTS`` without the id, and the lines that stay."""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    chars = word_chars(text)
    repeated = repeated_words(words)
    failed = len(words) < LEAST_WORDS or 100 * repeated > MOST_REPEATED * len(words)
    left, removed = clean_lines(text)
    lost = chars - sum(map(word_chars, left))
    verdict = (
        len(words),
        chars,
        len(text) - len(text.translate(_DROP_SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        failed,
        not failed and lost <= MOST_LOST * chars,
        len(lines),
        removed,
        lost,
    )
    return verdict, left


def judge(text: str | None) -> tuple:
    return examine(text or "")[0]


def cleaned_text(text: str | None) -> str | None:
    """The text without its failing lines; None if it is rejected."""
    verdict, left = examine(text or "")
    return "\n".join(left) if verdict[6] else None


def quality_verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: counts, ``base_failed`` and ``kept``.

    A NULL or empty text has no words and fails. Ids are passed on as they are, NULL or repeated; other columns are not
    read. No row depends on another.
    """
    schema = to_arrow_schema(_parse_datatype_string(VERDICTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            rows = list(zip(*map(judge, batch.column(1).to_pylist())))
            arrays = [batch.column(0), *(pa.array(c, f.type) for c, f in zip(rows, list(schema)[1:]))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, VERDICTS)


def apply_quality_rules(docs: DataFrame, text: str = "text", chars: str | None = None) -> DataFrame:
    """The documents that pass, with failing lines taken out of their texts; ``chars`` names a column that holds the
    text's length and follows it. All other columns and their order stay."""
    rows = docs.withColumn(text, F.col(f"`{text}`").cast("string"))
    schema, place = to_arrow_schema(rows.schema), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, ROW_BYTES):
            fresh = pa.array([cleaned_text(t) for t in batch.column(place).to_pylist()], schema.field(place).type)
            kept = batch.set_column(place, schema.field(place), fresh).filter(fresh.is_valid())
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(kept.columns, schema)], schema=schema)

    passed = rows.mapInArrow(run, rows.schema)
    if chars not in docs.columns:
        return passed
    return passed.withColumn(chars, F.char_length(f"`{text}`").cast(docs.schema[chars].dataType))


def op2_line_rules(spark, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))
