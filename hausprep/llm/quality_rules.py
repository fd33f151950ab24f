"""Quality rules by distribution divergence (operator 3).

Each language has two references, counted over all its documents of a minimum
length: the shares of character classes, and the shares of its common words
(words that make up at least ``COMMON_SHARE`` of the language's words, hence at
most ``1 / COMMON_SHARE`` words; all others are one class).  A document fails if
the Jensen-Shannon distance of its own shares to those of its language is too
large.  Common words are compared from the base rule's ``MIN_WORDS`` words on; below
``MIN_WORDS_COMMON`` words the limit widens with the chance in the shares.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hausprep.llm.common import in_pieces, pick, record

COMMON_SHARE = 0.002
MIN_WORDS = 50           # base rule, and least words of a document that counts for a reference
MIN_CHARS = 300          # least characters for the character classes to be compared
MIN_WORDS_COMMON = 150   # least words for the common words to be held to MAX_WORD_DISTANCE itself
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.36
MAX_REPEATED = 50        # per cent of the words

_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "blank", "stop", "quote", "symbol", "other ASCII",
           "other letter", "other upper", "other")


def _class_of(c: str) -> int:
    if c < "\x80":
        for k, known in enumerate((str.islower, str.isupper, str.isdigit, _BLANKS.__contains__, ".,;:?".__contains__,
                                   "'\"()-".__contains__, _SYMBOLS.__contains__)):
            if known(c):
                return k
        return 7
    return 9 if c.isupper() else 8 if c.isalpha() else 10


_TABLE: list[np.ndarray] = []


def class_counts(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(np.fromiter((_class_of(chr(i)) for i in range(0x110000)), np.uint8, 0x110000))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(_TABLE[0][points], minlength=len(CLASSES))


def split_words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``, as UTF-8 (bytes are split at exactly this white space)."""
    return text.encode("utf-8", "surrogatepass").split()


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = n = 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            n += i + 3 - max(i, covered)
            covered = i + 3
    return n


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """``word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    lines = Counter(line for line in text.split("\n") if line and not line.isspace() or line.strip(_BLANKS))
    return (len(text) - sum(text.count(c) for c in _BLANKS), sum(text.count(c) for c in _SYMBOLS),
            sum(lines.values()) - len(lines), repeated_words(words))


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2: 0 to 1) of two histograms of counts or shares."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    kl = sum(float(np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0]))) for x in (p, q))
    return math.sqrt(max(0.0, kl / 2))


class Reference:
    """The shares of one language."""

    def __init__(self, classes: np.ndarray, common: dict[bytes, int], total_words: int):
        self.classes = classes.astype(float)
        names = sorted(common)
        self.index = {w: i for i, w in enumerate(names)}
        self.words = np.array([common[w] for w in names] + [total_words - sum(common.values())], float)

    def distances(self, classes: np.ndarray, counts: Counter, n_words: int) -> tuple[float, float]:
        own = np.zeros(len(self.words))
        for w, i in self.index.items():
            own[i] = counts.get(w, 0)
        own[-1] = n_words - own.sum()
        return distance(classes.astype(float), self.classes), distance(own, self.words)


def learn_references(docs: DataFrame, common_share: float = COMMON_SHARE) -> dict[str, Reference]:
    """References of all non-null languages with a document of ``MIN_WORDS`` words or more.

    Tasks count before the shuffle; the driver gets at most ``1 / common_share`` words per language.
    """
    schema = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("word", pa.binary()), ("n", pa.int64())])

    def task(batches):
        classes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES), np.int64))
        words: dict[str, Counter] = defaultdict(Counter)
        totals: Counter = Counter()

        def counted():
            for lang, c in words.items():
                yield record(schema, [lang] * len(c), [-2] * len(c), list(c), list(c.values()))
            words.clear()

        for batch in batches:
            for part, texts in in_pieces(batch):
                for lang, text in zip(part.column("lang").to_pylist(), texts):
                    own = split_words(text)
                    if len(own) >= MIN_WORDS:
                        classes[lang] += class_counts(text)
                        words[lang].update(own)
                        totals[lang] += len(own)
                if sum(map(len, words.values())) > 400_000:
                    yield from counted()
        yield from counted()
        for lang, c in classes.items():
            yield record(schema, [lang] * (len(c) + 1), [*range(len(c)), -1], [None] * (len(c) + 1),
                         [*c.tolist(), totals[lang]])

    parts = pick(docs, "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull()) \
        .mapInArrow(task, "lang string, kind int, word binary, n long")
    counts = parts.groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))
    from hausprep.session import materialize

    counts = materialize(counts, "quality-counts")
    classes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES)))
    totals: dict[str, int] = {}
    for lang, kind, n in counts.where("kind >= -1").select("lang", "kind", "n").collect():
        if kind < 0:
            totals[lang] = n
        else:
            classes[lang][kind] = n
    least = F.lit(None).cast("double")
    for lang, n in totals.items():
        least = F.when(F.col("lang") == lang, common_share * n).otherwise(least)
    common: dict[str, dict] = defaultdict(dict)
    for lang, word, n in counts.where((F.col("kind") == -2) & (F.col("n") >= least)).select("lang", "word", "n").collect():
        common[lang][bytes(word)] = n
    return {lang: Reference(classes[lang], common[lang], totals[lang]) for lang in sorted(totals)}


def word_limit(n_words: int, max_word_distance: float = MAX_WORD_DISTANCE) -> float:
    """The largest common-word distance of a document of ``n_words`` words; chance falls with their square root."""
    return max_word_distance + max(0.0, n_words ** -0.5 - MIN_WORDS_COMMON ** -0.5)


def quality_rules(docs: DataFrame, max_char_distance: float = MAX_CHAR_DISTANCE,
                  max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, char_distance, word_distance`` (the distances are null where the document is too short to compare).

    ``base_failed``: fewer than 50 words, or more than half of them in repeated three-word windows.  A document of
    a null or unlearned language is held against the nearest reference; without any reference only the base rules
    hold.  Null texts have no words and fail.  Repeated rows give repeated results; other columns are not read.
    """
    references = learn_references(docs)
    held = docs.sparkSession.sparkContext.broadcast(references)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                        ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
                        ("base_failed", pa.bool_()), ("kept", pa.bool_()),
                        ("char_distance", pa.float64()), ("word_distance", pa.float64())])

    def verdict(text: str, lang: str | None, references) -> tuple:
        words = split_words(text)
        base = base_counts(text, words)
        failed = len(words) < MIN_WORDS or 100 * base[3] > MAX_REPEATED * len(words)
        against = [references[lang]] if lang in references else list(references.values())
        char = word = None
        if against and (len(text) >= MIN_CHARS or len(words) >= MIN_WORDS):
            classes, counts = class_counts(text), Counter(words)
            char, word = min(r.distances(classes, counts, len(words)) for r in against) if words else (1.0, 1.0)
            if len(text) < MIN_CHARS:
                char = None
            if len(words) < MIN_WORDS:
                word = None
        ok = not failed and (char is None or char <= max_char_distance) \
            and (word is None or word <= word_limit(len(words), max_word_distance))
        return len(words), *base, failed, ok, char, word

    def task(batches):
        for batch in batches:
            for part, texts in in_pieces(batch):
                langs = part.column("lang").to_pylist()
                rows = [verdict(t, lang, held.value) for t, lang in zip(texts, langs)]
                yield record(schema, part.column("doc_id"), *zip(*rows))

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], docs["lang"].cast("string").alias("lang"))
    return rows.mapInArrow(
        task, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, kept boolean, char_distance double, word_distance double")
