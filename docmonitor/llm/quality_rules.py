"""Quality rules: basic counts, and how far a text's make-up is from its language's.

A language's reference is made of two histograms over all its documents: of character
classes, and of its commonest words (with a cell for words that are marks only, and one
for all other words).  A document
is compared with each by the Jensen-Shannon distance; the nearest language counts, so a
wrong ``lang`` does no harm.  Texts too short to have a histogram are not judged by it, nor
are the words of a text whose own language has no reference: it has none of the others' words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmonitor.llm.common import read_table, rows_of_all, small_batches, text_or_empty, under_numbers
from docmonitor.session import materialise

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of the words
COMMON_WORDS = 100
REFERENCE_WORDS = 5_000  # of a language, for stable histograms
BLOCK_LANGUAGES = 500  # compared with in one pass
GUARD_CHARS = 200
GUARD_WORDS = 50
MOST_CHAR_DISTANCE = 0.30
MOST_WORD_DISTANCE = 0.54

#: lower-case letters, upper-case letters, digits, sentence marks, symbols, other marks
CLASSES = 6
_CLASS = np.full(256, 5, np.int64)
for _bytes, _class in ((range(97, 123), 0), (range(128, 256), 0), (range(65, 91), 1), (range(48, 58), 2),
                       (b".,;:!?'\"-()", 3), (SYMBOLS, 4)):
    _CLASS[list(_bytes)] = _class
_CLASS[list(b" \t\n\x0b\x0c\r")] = CLASSES
MARKS = bytes(i for i in range(128) if not chr(i).isalnum() and i not in b" \t\n\x0b\x0c\r")

COUNTS = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
          "n_repeat_words": pa.int64()}


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of five that come twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    code = ids[:n]
    for k in range(1, WINDOW):  # exact: each step numbers the windows so far anew
        code = np.unique(code * len(numbers) + ids[k:n + k], return_inverse=True)[1]
    again = np.bincount(code)[code] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    covered[at] += 1
    np.subtract.at(covered, at + WINDOW, 1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def base_counts(data: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    word_chars = sum(map(len, words)) - (0 if data.isascii() else sum(0x80 <= b < 0xC0 for b in data))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()] if b"\n" in data else []
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def char_histogram(data: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=CLASSES + 1)[:CLASSES]


def plain(words: list[bytes]) -> Counter:
    """Words in lower case, without marks at their ends."""
    found: Counter = Counter()
    for w, n in Counter(words).items():
        found[w.lower().strip(MARKS)] += n
    return found


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, from 0 to 1."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        both = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, both / 2)))


def references(docs: DataFrame, least_words: int = REFERENCE_WORDS) -> DataFrame:
    """A row a language: ``lang, chars`` (classes' counts), ``words`` (the common ones) and
    ``counts`` (theirs, then of words that are marks, then of all others).

    Counted over all whole texts.  Each task first sums what it has, so what is shuffled is
    a row a language, word and task.  A language has a reference from ``least_words`` words
    on, whatever the rest of the table holds.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        chars: dict[str, np.ndarray] = {}

        def flush():
            rows = [(lang, f"c{i}", int(n)) for lang, hist in chars.items() for i, n in enumerate(hist)]
            rows += [(lang, "w" + w.decode("utf-8", "replace"), n) for lang, c in words.items() for w, n in c.items()]
            words.clear()
            chars.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["lang", "cell", "n"])

        for lang, text in rows_of_all(batches):
            data = text.encode("utf-8", "replace")
            words.setdefault(lang, Counter()).update(plain(data.split()))
            chars[lang] = chars.get(lang, 0) + char_histogram(data)
            if sum(map(len, words.values())) > 200_000:
                yield flush()
        if chars:
            yield flush()

    texts = docs.where("lang IS NOT NULL").select(F.col("lang").cast("string"), text_or_empty().alias("text"))
    cells = (texts.mapInArrow(count, "lang string, cell string, n long")
             .groupBy("lang", "cell").agg(F.sum("n").alias("n")))
    cells = materialise(cells, "language-cells")
    is_word = F.col("cell").startswith("w")
    sizes = cells.groupBy("lang").agg(
        F.sum(F.when(is_word, F.col("n"))).alias("n_words"),
        F.coalesce(F.sum(F.when(F.col("cell") == "w", F.col("n"))), F.lit(0)).alias("n_marks"),
        *(F.sum(F.when(F.col("cell") == f"c{i}", F.col("n"))).alias(f"c{i}") for i in range(CLASSES)))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "cell")  # cut in each task before the shuffle
    top = (cells.where("cell LIKE 'w_%'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= COMMON_WORDS)
           .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", F.substring("cell", 2, 1 << 30).alias("word"), "n"))).alias("top")))
    common = F.coalesce(F.col("top.n"), F.array().cast("array<long>"))
    rest = F.col("n_words") - F.col("n_marks") - F.aggregate(common, F.lit(0).cast("long"), lambda x, y: x + y)
    rows = sizes.where(F.col("n_words") >= least_words).join(top, "lang", "left").select(
        "lang", F.array(*(f"c{i}" for i in range(CLASSES))).cast("array<double>").alias("chars"),
        F.coalesce(F.col("top.word"), F.array().cast("array<string>")).alias("words"),
        F.concat(common, F.array("n_marks", rest)).cast("array<double>").alias("counts"))
    return materialise(rows.where(F.exists("chars", lambda n: n > 0)), "references")


def reference_blocks(refs: DataFrame, most: int = BLOCK_LANGUAGES) -> list[dict]:
    """All references in blocks of some ``most`` languages, so that what a pass broadcasts (3 kB
    a language) has a bound however many there are; one block for any usual table."""
    n = max(1, -(-refs.count() // most))
    numbered = refs.withColumn("block", F.pmod(F.xxhash64("lang"), F.lit(n)))
    return [{r["lang"]: (np.array(r["chars"]), {w.encode(): i for i, w in enumerate(r["words"])}, np.array(r["counts"]))
             for r in numbered.where(F.col("block") == k).orderBy("lang").collect()} for k in range(n)]


def divergence(data: bytes, words: list[bytes], refs: dict, compare_words: bool,
               best: tuple[float | None, float | None] = (None, None)) -> tuple[float | None, float | None]:
    """Distances of characters and of common words to the nearest language, the one for
    which their sum is least, among ``refs`` and the ``best`` found before.  None where the
    text is too short, or there is no language; that of words also unless ``compare_words``."""
    hist = char_histogram(data)
    if hist.sum() < GUARD_CHARS:
        return best
    found = plain(words) if compare_words and len(words) >= GUARD_WORDS else None
    for chars, common, counts in refs.values():
        c, w = distance(hist, chars), None
        if found is not None:
            own = np.zeros(len(counts))
            for word in found.keys() & common.keys():
                own[common[word]] = found[word]
            own[-2] = found.get(b"", 0)
            own[-1] = len(words) - own.sum()
            w = distance(own, counts)
        if best[0] is None or c + (w or 0) < best[0] + (best[1] or 0):
            best = c, w
    return best


def judge(docs: DataFrame, most_char: float = MOST_CHAR_DISTANCE, most_word: float = MOST_WORD_DISTANCE,
          keep_columns: bool = False, least_words: int = REFERENCE_WORDS, block: int = BLOCK_LANGUAGES) -> DataFrame:
    """Counts, distances and the verdict of every document.

    ``base_failed``: fewer than ten words, or more than a fifth of the words stand in
    five-word windows that come twice or more.  ``kept``: not failed, and neither distance
    is over its limit; a distance that isn't known (short text, no language with a
    reference, or for words an own language without one) speaks for the document.  A null
    text has no words, so it fails.  Repeated rows are judged alike.  Texts are judged whole;
    a very long one is held with its words in its task.  An empty table gives an empty
    result.  With ``keep_columns`` the rows keep their own columns, whatever their names, and
    get ``kept`` (in the place of an own one) and no other.
    """
    refs = references(docs, least_words)
    own = ["doc_id"] if not keep_columns else [c for c in docs.columns if c != "kept"]
    need = list(dict.fromkeys([*own, "text", "lang"]))
    rows, inner = under_numbers(docs.select(*(F.col(f"`{c}`") for c in need)), ("doc_id", "text", "lang"))
    known = refs.select(F.col("lang").alias("_ref"), F.lit(True).alias("_known"))
    lang = F.col("lang").cast("string")
    rows = rows.join(known, lang == F.col("_ref"), "left").withColumn("_words", F.col("lang").isNull() | F.col("_known").isNotNull()).drop("_ref", "_known")
    carried = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in inner)
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
    found = "char_distance double, word_distance double"
    spark, passes = docs.sparkSession, reference_blocks(refs, block)
    # one pass counts; each takes the nearest so far on to its own block of languages
    for i, part in enumerate(passes):
        rows = rows.mapInArrow(_compare(spark.sparkContext.broadcast(part), inner, i == 0), f"{carried}, _words boolean, {counts}, {found}")
    near = lambda name, most: F.coalesce(F.col(name), F.lit(0.0)) <= most
    kept = ~F.col("base_failed") & near("char_distance", most_char) & near("word_distance", most_word)
    names = dict(zip(inner, need))
    out = [F.col(f"`{c}`").alias(names[c]) for c in inner if names[c] in own]
    if keep_columns:
        return rows.select(*out, kept.alias("kept"))
    return rows.select(*out, *(c.split()[0] for c in f"{counts}, {found}".split(", ")), kept.alias("kept"))


def _compare(model, carried: list[str], first: bool):
    made = {**COUNTS, "base_failed": pa.bool_()}
    distances = {"char_distance": pa.float64(), "word_distance": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = model.value
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c))
            got, near = [], []
            before = [(None, None)] * batch.num_rows if first else zip(*(column(c).to_pylist() for c in distances))
            failed = [None] * batch.num_rows if first else column("base_failed").to_pylist()
            for text, by_words, best, bad in zip(column("text").to_pylist(), column("_words").to_pylist(), before, failed):
                data = (text or "").encode("utf-8", "replace")
                words = data.split()
                if first:
                    counts = base_counts(data, words)
                    bad = counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED * counts[0]
                    got.append((*counts, bad))
                near.append((None, None) if bad else divergence(data, words, refs, by_words, best))
            out = {c: column(c) for c in [*carried, "_words"]}
            if first:
                out |= {k: pa.array(v, t) for (k, t), v in zip(made.items(), list(zip(*got)) or [()] * len(made))}
            else:
                out |= {c: column(c) for c in made}
            out |= {k: pa.array(v, t) for (k, t), v in zip(distances.items(), list(zip(*near)) or [(), ()])}
            yield pa.RecordBatch.from_pydict(out)

    return run


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    small_batches(spark)
    return judge(read_table(spark, sf_dir, "documents"))
