"""Hierarchical multi-length packing (operator 9).

Documents become token ids; each is cut into whole windows of the longest
context size and a rest, which is routed to the smallest tier that holds it.
Tiers are packed from the longest window down: a window opens with the longest
rest of its tier, its gap takes the longest fitting rests of the shorter tiers,
and what is left of the gap is filled by cutting a rest.  Every window is
therefore full.  What remains at the end of a task (less than one longest
window) is laid out in windows of powers of two, which need no padding either.
Windows of one tier are dealt to step groups of equal token count, the
attention cost (sum of squared piece lengths) balanced between the groups; only a
task's last group of a tier may be smaller.

Each task packs the documents it reads, so nothing is shuffled and a lost task
is repeated alone with the same result; it holds one block of pending tokens.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hausprep.llm.common import in_pieces, pick, record

TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 32 * 2048        # tokens of a step group
BLOCK_TOKENS = 1 << 19         # pending tokens that a task packs together
MAX_RUNS, MAX_WORDS = 150_000, 250_000     # of a generation of runs between white space, and of words, whose ids a worker keeps

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, tier long, step_group long")
_SCHEMA = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])

#: White space to Python's ``split`` but not to the tokenizer.
_NO_SPACE = "\x1c\x1d\x1e\x1f"
#: Runs and texts of only these characters are split into words here, by the tokenizer's own pattern.
_PLAIN = re.compile("[!-;=-~À-ÖØ-öø-įı-ɏ]+").fullmatch       # without "<", which begins special tokens
_PLAIN_TEXT = re.compile("[\t-\r -;=-~À-ÖØ-öø-įı-ɏ]*").fullmatch
_WORDS = re.compile(r"[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\w\s]|_)+").findall


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class _Known(dict):
    """Ids by key, in two generations: when the younger one is full it becomes the older one, whose keys move on
    when they are asked for again.  So what is used keeps its ids and what came once is forgotten."""

    def __init__(self, make, size: int):
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        self.keep(key, ids)
        return ids

    def keep(self, key: str, ids: bytes) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = ids


class WordIds:
    """Token ids of texts, as little-endian unsigned 32-bit bytes.

    The tokenizer normalises and splits what stands between white space by itself.  Texts of plain characters are split into
    words at once, other texts into runs between white space: words, also those of plain runs, go to the library's
    model, other runs through the whole library.  Ids are kept by word and by run."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.words = _Known(self._word, MAX_WORDS)
        self.plain_runs = _Known(self._plain_run, MAX_RUNS)
        self.runs = _Known(lambda run: self._library([run])[0], MAX_RUNS)
        self.ids = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = all(t.startswith("<") for t in specials) and all(self._library([t]) == [self._words(t)] for t in _TRIAL)

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [self._words(t) if self.plain and _PLAIN_TEXT(t) else None for t in texts]
        whole = [i for i, ids in enumerate(out) if ids is None and any(c in texts[i] for c in _NO_SPACE)]
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = ids
        split = {i: texts[i].split() for i, ids in enumerate(out) if ids is None}
        strange = {run for runs in split.values() for run in runs if not (self.plain and _PLAIN(run))}
        new = [run for run in strange if run not in self.runs and run not in self.runs.old]
        made = dict(zip(new, self._library(new)))                  # many at once
        for run, ids in made.items():
            self.runs.keep(run, ids)
        for i, runs in split.items():
            out[i] = b"".join([(made.get(r) or self.runs[r]) if r in strange else self.plain_runs[r] for r in runs])
        return out

    def _words(self, text: str) -> bytes:
        """Ids of a plain text."""
        return b"".join(map(self.plain_runs.__getitem__, text.split()))

    def _plain_run(self, run: str) -> bytes:
        """Ids of a plain run; most are a word, or a word and a mark."""
        run = run.lower()
        if run.isalpha():
            return self.words[run]
        if run[:-1].isalpha() and run[-1] in ".,;:!?":
            return self.words[run[:-1]] + self.words[run[-1]]
        return b"".join([self.words[w] for w in _WORDS(run)])

    def _word(self, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.ids[t.id] for t in self.model.tokenize(letters)])

    def _library(self, texts: list[str]) -> list[bytes]:
        return [b"".join(i.to_bytes(4, "little") for i in e.ids)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


#: If the words of these differ from the library's, the tokenizer is of another kind and all runs go through it.
_TRIAL = ("It's", "WE'LL", "a_b--c!", "Él", "1234", "straße's", "''s", "don'T.,", "Ŀœuvre", "¡Hola!")

_ENCODERS: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


class Packer:
    """Packs the pieces given to it; ``rows`` takes the finished ones.

    A piece is ``(length, start, doc, ids)`` with the ids as bytes and ``doc = (doc_id, doc_tokens)``.
    """

    def __init__(self, first_sequence: int, tiers=TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = sorted(tiers), step_tokens
        self.next_sequence = self.next_group = first_sequence
        self.pending: list[tuple] = []
        self.pending_tokens = 0
        self.rows: list[tuple] = []
        self.windows: dict[int, list[list[tuple]]] = {}

    def add(self, doc_id, ids: bytes) -> None:
        """Route a document: whole windows of the longest tier, and a rest."""
        tokens, longest = len(ids) // 4, self.tiers[-1]
        doc = (doc_id, tokens)
        for start in range(0, tokens - longest + 1, longest):
            self._window(longest, [(longest, start, doc, ids[4 * start:4 * (start + longest)])])
        start = tokens - tokens % longest
        if start < tokens:
            self.pending.append((tokens - start, start, doc, ids[4 * start:]))
            self.pending_tokens += tokens - start
        if self.pending_tokens >= BLOCK_TOKENS:
            self.pack()

    @staticmethod
    def _cut(piece: tuple, n: int) -> tuple[tuple, tuple]:
        length, start, doc, ids = piece
        return (n, start, doc, ids[:4 * n]), (length - n, start + n, doc, ids[4 * n:])

    def pack(self) -> None:
        """Fill windows with the pending rests, longest tier first; what can't fill one stays pending."""
        rests = sorted(self.pending, key=lambda p: p[0])
        lengths = [p[0] for p in rests]
        self.pending = []
        while rests:
            pieces = [rests.pop()]
            room = next(t for t in self.tiers if t >= lengths[-1])
            tier, room = room, room - lengths.pop()
            while room and rests:
                at = bisect_right(lengths, room)
                if at:                                    # the longest that fits
                    piece = rests.pop(at - 1)
                    lengths.pop(at - 1)
                else:                                     # all are longer: cut the shortest
                    piece, rest = self._cut(rests.pop(0), room)
                    lengths.pop(0)
                    at = bisect_right(lengths, rest[0])
                    rests.insert(at, rest)
                    lengths.insert(at, rest[0])
                pieces.append(piece)
                room -= piece[0]
            if room:
                self.pending = pieces
            else:
                self._window(tier, pieces)
        self.pending_tokens = sum(p[0] for p in self.pending)
        self._flush()

    def finish(self) -> None:
        """Pack all that is left, the last of it in windows of powers of two."""
        self.pack()
        left = list(reversed(self.pending))
        total = self.pending_tokens
        while total:
            size = 1 << (total.bit_length() - 1)
            size, room, pieces = min(size, self.tiers[-1]), min(size, self.tiers[-1]), []
            total -= size
            while room:
                piece = left.pop()
                if piece[0] > room:
                    piece, rest = self._cut(piece, room)
                    left.append(rest)
                pieces.append(piece)
                room -= piece[0]
            self._window(size, pieces)
        self.pending, self.pending_tokens = [], 0
        self._flush(last=True)

    def _window(self, tier: int, pieces: list[tuple]) -> None:
        self.windows.setdefault(tier, []).append(pieces)

    def _flush(self, last: bool = False) -> None:
        """Deal the windows of each tier to full step groups, costliest first and back and forth; what does not fill a
        group waits for the next flush, or is the tier's last group."""
        for tier, windows in sorted(self.windows.items()):
            per_group = max(1, self.step_tokens // tier)
            groups = -(-len(windows) // per_group) if last else len(windows) // per_group
            self.windows[tier] = windows[groups * per_group:]
            windows = sorted(windows[:groups * per_group], key=lambda w: -sum(p[0] * p[0] for p in w))
            for k, pieces in enumerate(windows):
                lap, at = divmod(k, groups)
                group = self.next_group + (at if lap % 2 == 0 else groups - 1 - at)
                offset = 0
                for length, start, (doc_id, tokens), ids in pieces:
                    self.rows.append((doc_id, start, length, zlib.crc32(ids), tokens,
                                      self.next_sequence, offset, tier, group))
                    offset += length
                self.next_sequence += 1
            self.next_group += groups


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int | None = 1,
                   tiers=TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pieces of all documents, one row each: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier, step_group``.

    A document's tokens are those of the tokenizer, then ``end_id`` (none if null).  Null or empty text
    is the end id alone (no piece at all without one).  Null ids and repeated rows are packed like any
    others; an empty table gives no rows; only ``doc_id`` and ``text`` are read.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def task(batches):
        packer = Packer(TaskContext.get().partitionId() << 40, tiers, step_tokens)
        enc = encoder(tokenizer_path)

        def done():
            rows, packer.rows = packer.rows, []
            return record(_SCHEMA, *zip(*rows))

        for batch in batches:
            for part, texts in in_pieces(batch):
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), enc.encode(texts)):
                    packer.add(doc_id, ids + end)
                if len(packer.rows) > 10_000:
                    yield done()
        packer.finish()
        if packer.rows:
            yield done()

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(task, PIECES)
