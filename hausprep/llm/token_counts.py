"""Token counts by finite-state transducers (operator 8).

Two deterministic transducers replace the tokenizer:

* The *splitter* reads character classes and marks where a pre-token begins.
  Its twelve states know the open pre-token; a transition is annotated with
  the boundaries it settles, at the current character or, where the pattern
  looks ahead, one character back.  Text is cut into chunks; each chunk's map
  from entry state to exit state is computed for all states at once, the maps
  are composed by a parallel prefix scan, and with every chunk's entry state
  known a last sweep over all chunks emits the boundaries.
* The *merger* reads the bytes of one pre-token; each transition is annotated
  with the number of tokens it adds (which may be negative, when a byte lets
  earlier tokens merge).  A state is the longest suffix that still begins some
  longer vocabulary token, with the last token and the relative count at those of its
  positions that a later token may begin at: exactly what decides every later token.  States are compiled when
  first reached and kept by the worker process.

Counts equal those of the tokenizer library, special strings in a text counting
as one token each (the library's default).
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hausprep.llm.common import in_pieces, pick, record

# Character classes.
LETTER, NUMBER, SPACE, BLANK, QUOTE, SYMBOL, STMD, R_OR_V, L, E, END = range(11)
N_CLASSES = 11
# States of the splitter.
START, WORD, DIGITS, MARKS, ONE_SPACE, ONE_BLANK, MANY_SPACE, MANY_BLANK, QUOTED, QUOTED_RV, QUOTED_L, CLOSED = range(12)
N_STATES = 12
HERE, BACK = 1, 2      # boundary before this character, before the previous one
CHUNK = 256
MAX_WORDS = 250_000    # pre-tokens whose count a worker keeps
MAX_STATES = 200_000   # merger states a worker keeps; further words are walked without keeping theirs


def _opened_by(c: int) -> int:
    """State after a pre-token that begins with class ``c``."""
    return {NUMBER: DIGITS, SPACE: ONE_SPACE, BLANK: ONE_BLANK, QUOTE: QUOTED, SYMBOL: MARKS,
            END: START}.get(c, WORD)


def _splitter_step(state: int, c: int) -> tuple[int, int]:
    letter = c in (LETTER, STMD, R_OR_V, L, E)
    blank = c in (SPACE, BLANK)
    # What goes on with the open pre-token, without a boundary here.
    if state in (QUOTED_RV, QUOTED_L):
        if (state, c) in ((QUOTED_RV, E), (QUOTED_L, L)):
            return CLOSED, 0
        return (WORD, BACK) if letter else (_opened_by(c), BACK | HERE)
    if state == QUOTED and letter:
        kept = {STMD: CLOSED, R_OR_V: QUOTED_RV, L: QUOTED_L}.get(c)
        return (kept, 0) if kept else (WORD, HERE)
    if state in (QUOTED, MARKS) and c in (QUOTE, SYMBOL):
        return MARKS, 0
    if state == WORD and letter or state == DIGITS and c == NUMBER:
        return state, 0
    if state in (ONE_SPACE, ONE_BLANK, MANY_SPACE, MANY_BLANK):
        if blank:
            return (MANY_SPACE if c == SPACE else MANY_BLANK), 0
        if c == END:
            return START, HERE
        settled = BACK if state in (MANY_SPACE, MANY_BLANK) else 0
        if state in (ONE_SPACE, MANY_SPACE):      # the last space joins what follows
            return (MARKS if c in (QUOTE, SYMBOL) else _opened_by(c)), settled
        return _opened_by(c), settled | HERE
    return _opened_by(c), HERE


_STEPS = [[_splitter_step(s, c) for s in range(N_STATES)] for c in range(N_CLASSES)]
NEXT = np.array([[s for s, _ in row] for row in _STEPS], np.uint8).ravel()
EMIT = np.array([[e for _, e in row] for row in _STEPS], np.uint8).ravel()


def character_classes(tokenizers) -> np.ndarray:
    """Class of every code point, letters and numbers as the library's patterns see them."""
    # Beyond 0x40000 Unicode has no letters, numbers or white space.
    index = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x40000)])
    every = index.astype("<u4").tobytes().decode("utf-32-le")
    classes = np.full(0x110000, SYMBOL, np.uint8)
    for pattern, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK)):
        split = tokenizers.pre_tokenizers.Split(tokenizers.Regex(pattern), "removed", invert=True)
        for _, (a, b) in split.pre_tokenize_str(every):
            classes[index[a:b]] = value
    for chars, value in ((" ", SPACE), ("'", QUOTE), ("stmd", STMD), ("rv", R_OR_V), ("l", L), ("e", E)):
        classes[[ord(c) for c in chars]] = value
    return classes


def compose_prefixes(maps: np.ndarray) -> np.ndarray:
    """Row ``i`` of the result is ``maps[i] o ... o maps[0]`` (doubling scan)."""
    out, step = maps.copy(), 1
    while step < len(out):
        later = np.take_along_axis(out[step:], out[:-step].astype(np.intp), axis=1)
        out[step:] = later
        step *= 2
    return out


def boundaries(classes: np.ndarray) -> np.ndarray:
    """True where a pre-token (or an END) begins, for a stream of classes that ends with END."""
    n = len(classes)
    rows = -(-n // CHUNK)
    padded = np.full(rows * CHUNK, END, np.uint16)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(rows, CHUNK).T) * N_STATES
    maps = np.tile(np.arange(N_STATES, dtype=np.uint8), (rows, 1))
    for c in columns:
        maps = NEXT[c[:, None] + maps]
    entry = np.zeros(rows, np.uint8)
    entry[1:] = compose_prefixes(maps)[:-1, START]
    emitted = np.empty((CHUNK, rows), np.uint8)
    state = entry
    for k, c in enumerate(columns):
        at = c + state
        emitted[k] = EMIT[at]
        state = NEXT[at]
    flat = np.ascontiguousarray(emitted.T).ravel()[:n]
    begins = (flat & HERE).astype(bool)
    begins[:-1] |= (flat[1:] & BACK).astype(bool)
    return begins


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Merger:
    """Token counts of byte strings by a lazily compiled transducer."""

    def __init__(self, model: dict):
        letters = _byte_letters()
        raw = {tuple(letters[c] for c in word): i for word, i in model["vocab"].items()}
        self.ids = {bytes(k): i for k, i in raw.items()}
        self.text = {i: k for k, i in self.ids.items()}
        self.rank, self.made_of, self.edges = {}, {}, {}
        for n, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = (bytes(letters[c] for c in x) for x in (a, b))
            self.rank[self.ids[a], self.ids[b]] = (n, self.ids[a + b])
            self.made_of.setdefault(self.ids[a + b], (n, self.ids[a], self.ids[b]))
        self.longer = {k[:n] for k in self.ids for n in range(1, len(k))}    # begin a longer token
        self.pairs: dict[tuple[int, int], bool] = {}
        first = (b"", ((-1, 0),))
        self.number, self.states, self.steps = {first: 0}, [first], [{}]

    def encode(self, data: bytes) -> list[int]:
        """Plain merging by rank: the definition the transducer is compiled from."""
        ids = [self.ids[data[i:i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            best = min((self.rank[p][0], p) if (p := (ids[i], ids[i + 1])) in self.rank else (1 << 60, p)
                       for i in range(len(ids) - 1))
            if best[0] == 1 << 60:
                break
            new, out, i = self.rank[best[1]][1], [], 0
            while i < len(ids):
                if i + 1 < len(ids) and (ids[i], ids[i + 1]) == best[1]:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def edge(self, token: int, right: bool) -> list[tuple[int, int, int]]:
        """The parts that stand at one end of ``token`` while it is being merged, from the whole
        down to a byte: (part, rank that forms it, rank that absorbs it)."""
        known = self.edges.get((token, right))
        if known is None:
            known, until = [], 1 << 60
            while token in self.made_of:
                rank, left_part, right_part = self.made_of[token]
                known.append((token, rank, until))
                until, token = rank, right_part if right else left_part
            known.append((token, -1, until))
            self.edges[token if len(known) == 1 else known[0][0], right] = known
        return known

    def follows(self, a: int, b: int) -> bool:
        """Whether token ``b`` can stand right after ``a`` (after nothing, if ``a`` is -1): no two
        parts that meet at their border while the two are being merged may merge earlier."""
        if a < 0:
            return True
        known = self.pairs.get((a, b))
        if known is None:
            ends, heads = self.edge(a, True), self.edge(b, False)
            i = j = 0
            known = True
            while i < len(ends) and j < len(heads):
                (x, formed_x, until_x), (y, formed_y, until_y) = ends[i], heads[j]
                merge = self.rank.get((x, y))
                if merge and merge[0] < until_x and merge[0] <= until_y:
                    known = False
                    break
                if formed_x >= formed_y:      # before the later one was formed, its part met the other
                    i += 1
                else:
                    j += 1
            if len(self.pairs) > 500_000:
                self.pairs.clear()
            self.pairs[a, b] = known
        return known

    def after(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """The state after one more byte, and the tokens it adds."""
        suffix, tails = state
        grown = suffix + bytes((byte,))
        for k, tail in enumerate(tails):            # the token may begin at any kept position
            token = self.ids.get(grown[k:])
            if token is not None and tail and self.follows(tail[0], token):
                added = tail[1] + 1
                break
        else:
            raise ValueError("no token ends here; the vocabulary lacks single bytes")
        cut = 0
        while grown[cut:] not in self.longer and cut < len(grown):
            cut += 1
        # A position matters while what stands behind it may yet grow into a token.
        kept = [(tails[k][0], tails[k][1] - added) if tails[k] and grown[k:] in self.longer else None
                for k in range(cut, len(grown))]
        return (grown[cut:], (*kept, (token, 0))), added

    def compile_step(self, number: int, byte: int) -> tuple[int, int]:
        state, added = self.after(self.states[number], byte)
        to = self.number.get(state)
        if to is None:
            to = self.number[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        self.steps[number][byte] = to, added
        return to, added

    def count(self, data: bytes) -> int:
        number = total = 0
        steps = self.steps
        for i, b in enumerate(data):
            go = steps[number].get(b)
            if go is None:
                if len(self.states) >= MAX_STATES:   # rare words: the same walk, not kept
                    state = self.states[number]
                    for c in data[i:]:
                        state, added = self.after(state, c)
                        total += added
                    return total
                go = self.compile_step(number, b)
            number = go[0]
            total += go[1]
        return total


class _Counts(dict):
    """Token count by pre-token; computed when first asked for."""

    def __init__(self, merger: Merger):
        self.merger = merger

    def __missing__(self, word: str) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        n = self[word] = self.merger.count(word.encode())
        return n


class TokenCounter:
    """Counts the tokens of texts as a byte-level BPE ``tokenizer.json`` gives them."""

    def __init__(self, path: str):
        import tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" \
                or spec["normalizer"] or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.classes = character_classes(tokenizers)
        self.counts = _Counts(Merger(spec["model"]))

    def count(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        for i, t in enumerate(texts):
            pieces = [t]
            for mark in self.special:
                if mark in t:
                    cut = [p.split(mark) for p in pieces]
                    total[i] += sum(len(p) - 1 for p in cut)
                    pieces = [x for p in cut for x in p]
            for p in pieces:
                if p:
                    parts.append(p)
                    owner.append(i)
        if not parts:
            return total
        stream = "\n".join(parts) + "\n"
        points = np.frombuffer(stream.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        classes = self.classes[points]
        classes[ends] = END
        begins = boundaries(classes)
        begins[ends] = True
        at = np.flatnonzero(begins)
        is_end = classes[at] == END
        first, last = at[~is_end], np.append(at[1:], len(points))[~is_end]
        words = [stream[a:b] for a, b in zip(first.tolist(), last.tolist())]
        n = np.fromiter(map(self.counts.__getitem__, words), np.int64, len(words))
        np.add.at(total, np.array(owner)[np.searchsorted(ends, first)], n)
        return total


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One counter per worker process, so that compiled states serve all its tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``tokenizer_path`` must exist on every executor.  A null text counts as empty (0 bytes, 0 tokens);
    a null ``doc_id`` stays null; repeated rows give repeated results; only ``doc_id`` and ``text`` are read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def task(batches):
        c = counter(tokenizer_path)
        for batch in batches:
            for part, texts in in_pieces(batch):
                yield record(schema, part.column("doc_id"), part.column("n_bytes"), c.count(texts))

    rows = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(task, "doc_id long, n_bytes long, n_tokens long") \
        .withColumn("over_limit", F.col("n_tokens") > limit)
