"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text is encoded as the segmentation of highest total piece score (the vocabulary's scores
taken as unigram log scores; ties go to the longer last piece), with byte pieces for what the
vocabulary lacks. Spaces become U+2581 and one is put in front; decoding undoes this exactly.
A literal U+2581 is spelt in byte pieces, so every text comes back as it was.

Texts over GIANT characters are cut into chunks of CHUNK characters that different tasks
encode. A piece may hang over the cut by up to one character less than the vocabulary's longest
piece has: that overhang is the boundary state. Each chunk gives the matrix of best scores from every entry state to every
exit state; matrices combine by the max-plus product, which is associative, in a tree; the
scores on entry then let each chunk trace its own path back, independently of the others, for
each of its exit states, and a last step picks the exits. No piece holds a space after another
character, so before such a space all states meet: within a chunk only the first and the last
word differ by state.

The vocabulary file is a parameter: it is read once, at the driver or by Spark's readers, and
its bytes (half a MB) go with the tasks. Defined results: a null text is like an empty one, no
tokens; repeated rows are encoded each; an empty table gives no rows; `encoded` keeps all columns
of docs but those named as its own; an id that the vocabulary lacks decodes as U+FFFD, and null
ids as null.
"""

from __future__ import annotations

import functools
import re
from importlib.util import find_spec
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import table, tidied, written

GIANT = 1 << 16
CHUNK = 1 << 15
SPACE = "▁"
CACHE = 120_000
#: Text that is encoded at once.
STEP_BYTES = 500_000
NONE = np.iinfo(np.int64).min // 4


def default_model() -> str:
    spec = find_spec("public_tokenizers")
    return str(Path(spec.origin).parent / "piece_bpe_32k.model") if spec else "/opt/tokenizers/piece_bpe_32k.model"


def model_bytes(spark: SparkSession, path: str | None) -> bytes:
    """The vocabulary file, from the driver's disk or from any store that Spark reads."""
    path = path or default_model()
    if Path(path).is_file():
        return Path(path).read_bytes()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])


class Slots:
    """Pieces by a 64-bit hash, in two direct-address tables for vectors of lookups."""

    BITS = 17
    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, entries: dict[str, tuple[int, int]]):
        keys = np.array([self.of(p) for p in entries], np.uint64)
        if len(set(keys.tolist())) != len(keys):
            raise ValueError("two pieces share a hash")
        values = np.array(list(entries.values()), np.int64)
        self.tables = []
        multiplier = np.uint64(0xD6E8FEB86659FD93)
        while len(keys):
            # what collides in one table goes to the next
            multiplier = np.uint64((int(multiplier) * 0xBF58476D1CE4E5B9 + 0x94D049BB133111EB | 1) & 0xFFFFFFFFFFFFFFFF)
            slot = (keys * multiplier) >> np.uint64(64 - self.BITS)
            _, first = np.unique(slot, return_index=True)
            key, score, ids = np.zeros(1 << self.BITS, np.uint64), np.full(1 << self.BITS, LOW, np.int32), np.zeros(1 << self.BITS, np.int32)
            key[slot[first]], score[slot[first]], ids[slot[first]] = keys[first], values[first, 0], values[first, 1]
            left = np.ones(len(keys), bool)
            left[first] = False
            more = np.zeros(1 << self.BITS, bool)
            more[slot[left]] = True
            self.tables.append((multiplier, key, score, ids, more))
            keys, values = keys[left], values[left]

    @classmethod
    def of(cls, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * cls.BASE + cls.letter(ord(c))) & 0xFFFFFFFFFFFFFFFF
        return h

    @staticmethod
    def letter(code: int) -> int:
        return (code + 1) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF ^ (code << 17)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score (LOW: no piece) and id for each hash. Only hashes whose slot was taken by another
        piece are looked up in the next table."""
        flat = np.ascontiguousarray(h).ravel()
        score, ids, at = np.full(len(flat), LOW, np.int32), np.zeros(len(flat), np.int32), None
        for multiplier, key, s, i, more in self.tables:
            slot = (flat * multiplier) >> np.uint64(64 - self.BITS)
            hit = key[slot] == flat
            there = slot[hit]
            to = hit if at is None else at[hit]
            score[to], ids[to] = s[there], i[there]
            rest = np.flatnonzero(more[slot] & ~hit)
            if not len(rest):
                break
            at = rest if at is None else at[rest]
            flat = flat[rest]
        return score.reshape(h.shape), ids.reshape(h.shape)


#: No piece: far below any word's score, and two of them still fit 32 bits.
LOW = -(1 << 29)
#: Score of a piece that is taken only where nothing else fits.
LAST = -4_000_000
#: Longest run that is encoded with others, many at a time.
VECTOR_LENGTH = 48
#: Characters of the runs that are encoded at once: some 20 MB of arrays.
VECTOR_CHARS = 100_000


class Vocabulary:
    """Pieces with integer scores, and the byte pieces."""

    def __init__(self, pieces: list[str], scores: list[int], first_byte: int | list[int]):
        self.score = dict(zip(pieces, scores, strict=True))
        self.first_byte = first_byte
        self.unknown = min(scores) - 10
        self.longest = max(map(len, pieces))
        self.ids: dict[str, int] = {}
        self.known: dict[str, tuple[int, bytes]] = {}
        self.surface: list[bytes] = []

    @classmethod
    def load(cls, data: bytes) -> Vocabulary:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_proto=data)
        size = m.get_piece_size()
        normal = [i for i in range(size) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        bytes_ = {int(m.id_to_piece(i)[1:-1], 16): i for i in range(size) if m.is_byte(i)}
        if len(bytes_) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        # pieces with the score of -1e9 (runs of spaces) are those of last resort: what is left of
        # that number here still outweighs any run of others
        scores = [max(round(m.get_score(i)), LAST) for i in normal]
        pieces = [m.id_to_piece(i) for i in normal]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("a piece holds a space after another character")
        self = cls(pieces, scores, [bytes_[b] for b in range(256)])
        self.ids = dict(zip(pieces, normal, strict=True))
        self.surface = [b""] * size
        for p, i in self.ids.items():
            self.surface[i] = p.replace(SPACE, " ").encode()
        for b, i in bytes_.items():
            self.surface[i] = bytes([b])
        # an unknown ASCII character is one byte piece; others take several, and the slow way
        alone = {chr(b): (self.unknown, bytes_[b]) for b in range(128) if chr(b) not in self.ids}
        self.slots = Slots({p: (self.score[p], i) for p, i in self.ids.items()} | alone)
        self.plain = {chr(b) for b in range(128)} | {p for p in self.ids if len(p) == 1}
        return self

    def many(self, runs: list[str]) -> list[tuple[int, bytes]]:
        """segment() of many runs, vectorised over runs of about one length."""
        out: list = [None] * len(runs)
        by: dict[int, list[int]] = {}
        plain = self.plain
        for k, s in enumerate(runs):
            if 0 < len(s) <= VECTOR_LENGTH and plain.issuperset(s) and "\0" not in s:
                by.setdefault(-(-len(s) // 6) * 6, []).append(k)
            else:
                out[k] = self.slow(s)
        for width, places in by.items():
            rows = VECTOR_CHARS // width
            for i in range(0, len(places), rows):
                part = places[i : i + rows]
                for k, got in zip(part, self.block([runs[k] for k in part], width), strict=True):
                    out[k] = got
        return out

    def block(self, runs: list[str], width: int) -> list[tuple[int, bytes]]:
        n = len(runs)
        lengths = np.fromiter(map(len, runs), np.int64, n)
        codes = np.array(runs, f"U{width}").view(np.uint32).reshape(n, width).T.astype(np.uint64)
        letters = (codes + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F) ^ (codes << np.uint64(17))
        prefix = np.zeros((width + 1, n), np.uint64)
        for j in range(width):
            prefix[j + 1] = prefix[j] * np.uint64(Slots.BASE) + letters[j]
        power, score, ids = 1, [None], [None]
        for d in range(1, min(self.longest, width) + 1):
            power = power * Slots.BASE & 0xFFFFFFFFFFFFFFFF
            a, b = self.slots.find(prefix[d:] - prefix[: width + 1 - d] * np.uint64(power))
            score.append(a)
            ids.append(b)
        best = np.full((width + 1, n), 4 * LOW // 3, np.int32)
        back, last = np.zeros((width + 1, n), np.int8), np.zeros((width + 1, n), np.int32)
        best[0] = 0
        for j in range(1, width + 1):
            for i in range(max(0, j - self.longest), j):
                x = best[i] + score[j - i][i]
                better = x > best[j]  # an earlier begin, a longer piece, wins ties
                if better.any():
                    np.copyto(best[j], x, where=better)
                    np.copyto(last[j], ids[j - i][i], where=better)
                    back[j][better] = i
            np.maximum(best[j], LOW, out=best[j])
        filled = np.zeros((n, width), np.int32)
        at, row, column = lengths.copy(), np.arange(n), np.full(n, width)
        while len(row):
            column[row] -= 1
            filled[row, column[row]] = last[at[row], row]
            at[row] = back[at[row], row]
            row = row[at[row] > 0]
        data = filled.tobytes()
        total = best[lengths, np.arange(n)].tolist()
        return [(t, data[(k * width + c) * 4 : (k + 1) * width * 4]) for k, (t, c) in enumerate(zip(total, column.tolist(), strict=True))]

    def learn(self, runs) -> None:
        """All of runs are known from here on; beyond CACHE, what was known before is forgotten."""
        new = [s for s in runs if s not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = list(runs)
        self.known.update(zip(new, self.many(new), strict=True))

    def forward(self, s: str, entry: dict[int, int], stop: int | None = None) -> tuple[list[int], list[int]]:
        """Best score of each position of s and where its last piece begins.

        entry: position -> score on entry. Pieces begin before `stop` (default: the end).
        """
        n = len(s)
        stop = n if stop is None else stop
        best, back = [NONE] * (n + 1), [-1] * (n + 1)
        for i, x in entry.items():
            if i <= n:
                best[i] = x
        score, longest = self.score, self.longest
        for i in range(stop):
            here = best[i]
            if here == NONE:
                continue
            single = False
            for j in range(i + 1, min(i + longest, n) + 1):
                x = score.get(s[i:j])
                if x is not None:
                    single |= j == i + 1
                    if here + x > best[j]:  # an earlier begin, a longer piece, wins ties
                        best[j], back[j] = here + x, i
            if not single and here + self.unknown > best[i + 1]:
                best[i + 1], back[i + 1] = here + self.unknown, i
        return best, back

    def spell(self, part: str) -> list[int]:
        i = self.ids.get(part)
        return [i] if i is not None else [self.first_byte[b] for b in (SPACE_BYTES if part == LITERAL else part.encode("utf-8", "surrogatepass"))]

    def trace(self, s: str, back: list[int], end: int) -> tuple[list[int], int]:
        """ids of the path that ends at `end`, and the entry it comes from."""
        parts, at = [], end
        while back[at] >= 0:
            parts.append(s[back[at] : at])
            at = back[at]
        out: list[int] = []
        for p in reversed(parts):
            out += self.spell(p)
        return out, at

    def segment(self, s: str) -> tuple[int, bytes]:
        """Score and ids (int32 bytes) of a run without inner cut."""
        got = self.known.get(s)
        return self.slow(s) if got is None else got

    def slow(self, s: str) -> tuple[int, bytes]:
        best, back = self.forward(s, {0: 0})
        ids, _ = self.trace(s, back, len(s))
        return best[-1], np.array(ids, np.int32).tobytes()


#: Stands for a literal U+2581 of the text, spelt out in bytes like any unknown: a lone surrogate,
#: which no text holds.
LITERAL = "\ud800"
SPACE_BYTES = SPACE.encode()
#: Ids that are decoded at once: some 20 MB of arrays.
DECODE_IDS = 200_000
#: What an id that the vocabulary lacks decodes as.
UNKNOWN = "\ufffd".encode()
CUT = re.compile(f"(?<=[^{SPACE}])(?={SPACE})")
RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def escaped(text: str) -> str:
    """The text with U+2581 for spaces; length is kept."""
    return text.replace(SPACE, LITERAL).replace(" ", SPACE)


@functools.lru_cache(2)
def vocabulary(data: bytes) -> Vocabulary:
    return Vocabulary.load(data)


def runs_of(text: str | None) -> list[str]:
    """The runs of a whole text between cuts: each with the spaces before it."""
    if not text:
        return []
    if "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
        return (SPACE + text.replace(" ", " " + SPACE)).split(" ")
    return RUNS.findall(SPACE + escaped(text))


def encode_all(texts: list[str | None], v: Vocabulary) -> list[bytes]:
    """ids of whole texts, as int32 bytes."""
    runs = [runs_of(t) for t in texts]
    v.learn(set().union(*runs))
    known = v.known
    return [b"".join([known[s][1] for s in r]) for r in runs]


def encode(text: str | None, v: Vocabulary) -> bytes:
    return encode_all([text], v)[0]


def decode(ids: list[int], v: Vocabulary) -> str:
    size = len(v.surface)
    try:
        data = b"".join(map(v.surface.__getitem__, ids))
        if min(ids, default=0) < 0:
            raise IndexError
    except IndexError:
        data = b"".join(v.surface[i] if 0 <= i < size else UNKNOWN for i in ids)
    return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


class Surfaces:
    """What each id stands for, end to end, for many ids at once; one more for ids there are none."""

    def __init__(self, v: Vocabulary):
        parts = [*v.surface, UNKNOWN]
        self.none = len(v.surface)
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.length = np.array([len(x) for x in parts], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.spaced = np.array([x[:1] == b" " for x in parts])

    def texts(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array | None:
        """Arrow text of the documents whose ids lie between offsets; None if some bytes are no UTF-8."""
        ids = np.where((ids >= 0) & (ids < self.none), ids, self.none)
        length, start = self.length[ids], self.start[ids]
        # the space that encoding puts in front goes
        first = offsets[:-1][np.diff(offsets) > 0]
        first = first[self.spaced[ids[first]]]
        length[first] -= 1
        start[first] += 1
        ends = np.r_[0, np.cumsum(length)]
        data = self.data[np.arange(ends[-1]) + np.repeat(start - ends[:-1], length)]
        out = pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(ends[offsets].astype(np.int32)), pa.py_buffer(data)])
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:
            return None
        return out


@functools.lru_cache(2)
def surfaces(data: bytes) -> Surfaces:
    return Surfaces(vocabulary(data))


def decode_all(lists: pa.ListArray, model: bytes) -> pa.Array:
    """Texts of lists of ids, DECODE_IDS ids or one list at a time; null for null."""
    s, parts = surfaces(model), []
    offsets = lists.offsets.to_numpy().astype(np.int64)
    ids, begin = lists.values.to_numpy(zero_copy_only=False), 0
    while begin < len(lists):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + DECODE_IDS, side="right")) - 1)
        own = offsets[begin : end + 1]
        got = s.texts(ids[own[0] : own[-1]], own - own[0])
        if got is None:
            got = pa.array([decode(ids[i:j].tolist(), vocabulary(model)) for i, j in zip(own[:-1], own[1:], strict=True)], pa.string())
        parts.append(got)
        begin = end
    out = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
    return pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), out) if lists.null_count else out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product; sums with an unreachable state stay unreachable."""
    c = (a[:, :, None] + b[None]).max(1)
    return np.where(c < NONE // 2, NONE, c)


def scan(ms: list[np.ndarray]) -> list[np.ndarray]:
    """Products of all prefixes: pairs are combined, their scan is spread out again."""
    if len(ms) <= 1:
        return ms
    pairs = scan([product(ms[i], ms[i + 1]) for i in range(0, len(ms) - 1, 2)])
    return [ms[0] if i == 0 else pairs[i // 2] if i % 2 else product(pairs[i // 2 - 1], ms[i]) for i in range(len(ms))]


def chunk_parts(s: str, size: int) -> tuple[int, int]:
    """The first and last cut within the chunk's `size` characters (-1: none)."""
    cuts = [m.start() for m in CUT.finditer(s, 0, min(size, len(s))) if m.start() < size]
    return (cuts[0], cuts[-1]) if cuts else (-1, -1)


def transfer(s: str, size: int, v: Vocabulary) -> np.ndarray:
    """Best scores from entry i to exit j of a chunk: s holds it and what may hang over."""
    n = v.longest
    m = np.full((n, n), NONE, np.int64)
    first, last = chunk_parts(s, size)

    def exits(best: list[int]) -> np.ndarray:
        return np.array([best[size + j] if size + j < len(best) else NONE for j in range(n)], np.int64)

    if first < 0:
        for i in range(n):
            m[i] = exits(v.forward(s, {i: 0}, size)[0]) if i <= len(s) else NONE
        return m
    runs = RUNS.findall(s[first:last])
    v.learn(set(runs))
    middle = sum(v.segment(x)[0] for x in runs)
    tail = v.forward(s[last:], {0: 0}, size - last)[0]
    tail = np.array([tail[size - last + j] if size - last + j < len(tail) else NONE for j in range(n)], np.int64)
    for i in range(min(n, first + 1)):
        head = v.forward(s[:first], {i: 0})[0][first]
        if head != NONE:
            m[i] = np.where(tail == NONE, NONE, tail + head + middle)
    return m


def paths(s: str, size: int, entry: np.ndarray, v: Vocabulary) -> tuple[list[int], list[bytes], bytes]:
    """For each exit state: the entry state its path comes from (-1: none) and its last ids;
    and the ids that all paths share, which come before."""
    n = v.longest
    first, last = chunk_parts(s, size)
    start = {i: int(x) for i, x in enumerate(entry) if x != NONE}
    if first < 0:
        best, back = v.forward(s, start, size)
        shared, from_, offset = b"", None, 0
    else:
        _, head = v.forward(s[:first], {i: x for i, x in start.items() if i <= first})
        ids, from_ = v.trace(s[:first], head, first)
        runs = RUNS.findall(s[first:last])
        v.learn(set(runs))
        shared = np.array(ids, np.int32).tobytes() + b"".join(v.segment(x)[1] for x in runs)
        offset = last
        best, back = v.forward(s[last:], {0: 0}, size - last)
    rest = s[offset:]
    entries, tails = [], []
    for j in range(n):
        at = size - offset + j
        if at >= len(best) or best[at] == NONE:
            entries.append(-1)
            tails.append(b"")
            continue
        ids, came = v.trace(rest, back, at)
        entries.append(came if from_ is None else from_)
        tails.append(np.array(ids, np.int32).tobytes())
    return entries, tails, shared


def id_lists(parts: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in parts], out=offsets[1:])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def columns_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def plain(docs: DataFrame, model: bytes, check: bool = False) -> DataFrame:
    """docs and pieces_ids, each text encoded by one task; with `check`, round_trip as well:
    whether the ids decode to the text."""

    def run(batches):
        v = vocabulary(model)
        for b in batches:
            # few texts at a time: a batch's ids take several times its text
            column = b.column("text")
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            begin, held = 0, 0
            for i in range(b.num_rows):
                held += int(sizes[i])
                if held > STEP_BYTES or i == b.num_rows - 1:
                    part = b.slice(begin, i + 1 - begin)
                    ids = id_lists(encode_all(part.column("text").to_pylist(), v))
                    more = [ids]
                    if check:
                        more.append(pc.equal(decode_all(ids, model), pc.fill_null(part.column("text"), "")))
                    yield pa.RecordBatch.from_arrays([*part.columns, *more], [*b.schema.names, "pieces_ids", "round_trip"][: len(part.columns) + len(more)])
                    begin, held = i + 1, 0
        v.known.clear()

    return docs.mapInArrow(lambda b: tidied(run(b)), f"{columns_of(docs)}, pieces_ids array<int>" + ", round_trip boolean" * check)


def longest_piece(data: bytes) -> int:
    """Characters of the vocabulary's longest piece; the vocabulary itself is not kept."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_proto=data)
    return max(len(m.id_to_piece(i)) for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)))


def giants(docs: DataFrame, model: bytes, chunk: int = CHUNK) -> DataFrame:
    """g_id, g_code, pieces_ids of the distinct (doc_id, text) of docs, by chunks."""
    longest = longest_piece(model)
    texts = docs.select(F.col("doc_id").alias("g_id"), F.xxhash64("text").alias("g_code"), F.concat(F.lit(" "), "text").alias("t")).dropDuplicates(["g_id", "g_code"])
    n = F.ceil(F.length("t") / chunk).cast("int")
    chunks = texts.select("g_id", "g_code", n.alias("n"), "t", F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
    chunks = written(chunks.select("g_id", "g_code", "n", "k", F.substring("t", F.col("k") * chunk + 1, F.lit(chunk + longest - 1)).alias("s"), F.least(F.lit(chunk), F.length("t") - F.col("k") * chunk).alias("size")), "pieces-chunks")

    def matrices(batches):
        v = vocabulary(model)
        for b in batches:
            ms = [transfer(escaped(s), size, v).tobytes() for s, size in zip(b.column("s").to_pylist(), b.column("size").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("g_id", "g_code", "n", "k")), pa.array(ms, pa.binary())], ["g_id", "g_code", "n", "k", "m"])

    def entries(t: pa.Table) -> pa.Table:
        t = t.sort_by("k")
        size = vocabulary(model).longest
        ms = [np.frombuffer(m.as_py(), np.int64).reshape(size, size) for m in t.column("m")]
        first = np.full(size, NONE, np.int64)
        first[0] = 0
        vs = [first, *(product(first[None], p)[0] for p in scan(ms)[:-1])]
        # only differences count, and they stay small however long the text is
        vs = [np.where(x == NONE, NONE, x - x.max()) for x in vs]
        return pa.Table.from_arrays([t.column("g_id"), t.column("g_code"), t.column("k"), pa.array([x.tobytes() for x in vs], pa.binary())], ["g_id", "g_code", "k", "entry"])

    def traced(batches):
        v = vocabulary(model)
        for b in batches:
            out = [paths(escaped(s), size, np.frombuffer(e, np.int64), v) for s, size, e in zip(b.column("s").to_pylist(), b.column("size").to_pylist(), b.column("entry").to_pylist(), strict=True)]
            cols = [pa.array([o[0] for o in out], pa.list_(pa.int32())), pa.array([o[1] for o in out], pa.list_(pa.binary())), pa.array([o[2] for o in out], pa.binary())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("g_id", "g_code", "k")), *cols], ["g_id", "g_code", "k", "came", "tails", "shared"])

    def joined(t: pa.Table) -> pa.Table:
        t = t.sort_by("k")
        came, tails, shared = (t.column(c).to_pylist() for c in ("came", "tails", "shared"))
        state, parts = 0, []
        for k in range(len(came) - 1, -1, -1):
            parts += [tails[k][state], shared[k]]
            state = came[k][state]
        return pa.Table.from_arrays([t.column("g_id").slice(0, 1), t.column("g_code").slice(0, 1), id_lists([b"".join(reversed(parts))])], ["g_id", "g_code", "pieces_ids"])

    kind = dict(docs.dtypes)["doc_id"]
    by = ["g_id", "g_code"]
    # matrices and paths are small beside the texts, and a text's all go into its one row anyway
    on_entry = chunks.mapInArrow(matrices, f"g_id {kind}, g_code long, n int, k int, m binary").groupBy(*by).applyInArrow(entries, f"g_id {kind}, g_code long, k int, entry binary")
    e = on_entry.withColumnsRenamed({"g_id": "e_id", "g_code": "e_code", "k": "e_k"})
    ready = chunks.join(e, chunks["g_id"].eqNullSafe(e["e_id"]) & (chunks["g_code"] == e["e_code"]) & (chunks["k"] == e["e_k"])).select("g_id", "g_code", "k", "s", "size", "entry")
    found = ready.mapInArrow(traced, f"g_id {kind}, g_code long, k int, came array<int>, tails array<binary>, shared binary")
    return found.groupBy(*by).applyInArrow(joined, f"g_id {kind}, g_code long, pieces_ids array<int>")


def encoded(docs: DataFrame, model: str | None = None, giant: int = GIANT, chunk: int = CHUNK, check: bool = False) -> DataFrame:
    """All columns of docs, and token_ids and n_tokens (in place of columns so named); with
    `check` also round_trip, whether decoding gives the text (or '' for null) back."""
    data = model_bytes(docs.sparkSession, model)
    docs = docs.select(*[docs[c] for c in docs.columns if c.lower() not in ("token_ids", "n_tokens", "pieces_ids", "round_trip")])
    long = F.coalesce(F.length("text") > giant, F.lit(False))
    usual = plain(docs.where(~long), data, check)
    big = docs.where(long)
    done = written(giants(big, data, chunk), "pieces-giants")
    of = big.join(done, big["doc_id"].eqNullSafe(done["g_id"]) & (F.xxhash64(big["text"]) == done["g_code"])).select(*[big[c] for c in big.columns], "pieces_ids")
    if check:
        of = decode_column(of, "pieces_ids", "back", data).withColumn("round_trip", F.col("back") == F.col("text")).drop("back")
    return usual.unionByName(of).withColumn("n_tokens", F.size("pieces_ids").cast("long")).withColumnRenamed("pieces_ids", "token_ids")


def decode_column(df: DataFrame, ids: str, name: str, model: bytes) -> DataFrame:
    """df with `name`, the texts of the lists of ids in column `ids`."""

    def run(batches):
        for b in batches:
            lists = b.column(ids).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, decode_all(lists, model)], [*b.schema.names, name])

    return df.mapInArrow(lambda b: tidied(run(b)), f"{columns_of(df)}, {name} string")


def decoded(df: DataFrame, model: str | None = None) -> DataFrame:
    """All columns of df, and decoded: the text of token_ids (null: null)."""
    df = df.select(*[df[c] for c in df.columns if c.lower() != "decoded"])
    return decode_column(df, "token_ids", "decoded", model_bytes(df.sparkSession, model))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids, and whether decoding them gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs, check=True).select("doc_id", "n_tokens", "token_ids", "round_trip")
