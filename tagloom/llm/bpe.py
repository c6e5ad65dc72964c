"""Byte-level BPE as a finite-state transducer, and streaming decoding.

**Encoding.** A sequence of tokens is the BPE encoding of its bytes exactly if every two neighbours are the encoding of
their joined bytes. So each prefix of a text has one last token: the one that ends there and agrees with the last token
of the prefix before it. The transducer reads a byte at a time. Its state holds the token starts that are still open,
each as a place in the trie of all tokens and the last token of the prefix before it; a step names the last token of the
prefix read so far. Followed back from the open starts, token by token, the ways meet at one place, and what lies before it is
final whatever comes: this is the lookahead, some tokens' lengths in practice, and all that a stream holds back. States
and steps come into being when first needed and are forgotten beyond a bound; a forgotten one is made again.

**Decoding.** Tokens may end inside a character. :class:`Utf8Stream` keeps the open bytes of a character between chunks.

Texts are split by the tokenizer's pattern, and a match that is itself a token becomes that token, as in the tiktoken
library. Defined cases: null and empty text have no ids and decode to nothing; rows that repeat are encoded each;
columns beyond the named ones are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import row_slices, text_batches
from tagloom.llm.units import PieceCache, encoded_segments
from tagloom.llm.words import text_bytes

#: Bounds of what a worker keeps, some 100 MB in all.
TRANSITIONS = 150_000
PAIRS = 200_000
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: A stream looks for final tokens so often; pieces beyond LONG bytes are encoded as streams.
LOOK, LONG = 64, 1024
DECODE_STEP = 1 << 18
SLICE_BYTES = 4 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The definition: join the neighbours of lowest rank, leftmost first, until none can be joined."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Encodes byte strings by the merges of ``ranks``; see the module's text."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        self.depth: list[int] = [0]
        for token, i in ranks.items():
            if merge(token, ranks) != [token]:
                continue  # no merges lead to it
            node = 0
            for byte in token:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = self.children[node][byte]
            self.token_at[node] = i
        self.length = {i: len(t) for i, t in self.tokens.items()}
        self.agrees: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        # a state: trie node and token before the start (or -1) of each open start in turn, the earliest first, the root last
        start = (0, -1)
        self.states: dict[tuple, int] = {start: 0}
        self.content: list[tuple] = [start]
        self.steps: list[dict[int, tuple[int, int]]] = [{}]
        self.made = 0

    def _agree(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self.agrees.get(key)
        if found is None:
            if len(self.agrees) > PAIRS:
                self.agrees.clear()
            a, b = self.tokens[left], self.tokens[right]
            found = self.agrees[key] = a + b not in self.ranks and merge(a + b, self.ranks) == [a, b]
        return found

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        alive, here = [], -1
        opened = self.content[state]
        for k in range(0, len(opened), 2):
            node, before = self.children[opened[k]].get(byte), opened[k + 1]
            if node is None:
                continue
            token = self.token_at[node]
            if token >= 0 and here < 0 and (before < 0 or self._agree(before, token)):
                here = token
            if self.children[node]:
                alive += (node, before)
        if here < 0:
            raise ValueError("the ranks lack a byte")
        key = (*alive, 0, here)
        to = self.states.get(key)
        if to is None:
            to = self.states[key] = len(self.content)
            self.content.append(key)
            self.steps.append({})
        self.made += 1
        self.steps[state][byte] = found = (to, here)
        return found

    def _final(self, last: list[int], state: int) -> int:
        """The place where the ways back from all open starts meet; tokens before it stay as they are."""
        heads = {len(last) - self.depth[node] for node in self.content[state][::2]}
        while len(heads) > 1:
            top = max(heads)
            heads.remove(top)
            heads.add(top - self.length[last[top - 1]])
        return heads.pop()

    def stream(self, chunks: Iterable[bytes]) -> Iterator[int]:
        """Tokens of a byte stream as soon as they are final; it is looked for them every LOOK bytes."""
        last: list[int] = []  # last token by position, from the last final one on
        state, look = 0, LOOK
        self.held = 0  # most bytes held back so far, for those who watch the bound
        for chunk in chunks:
            for byte in chunk:
                state, token = self.steps[state].get(byte) or self._step(state, byte)
                last.append(token)
                if len(last) >= look:
                    self.held = max(self.held, len(last))
                    final = self._final(last, state)
                    yield from self._back(last[:final])
                    del last[:final]
                    look = len(last) + LOOK
        yield from self._back(last)

    def _back(self, last: list[int]) -> list[int]:
        out, at = [], len(last)
        while at:
            token = last[at - 1]
            out.append(token)
            at -= self.length[token]
        out.reverse()
        return out

    def encode(self, piece: bytes) -> list[int]:
        if self.made > TRANSITIONS:
            self.forget()
        if len(piece) > LONG:
            return list(self.stream([piece]))
        last, state, steps = [], 0, self.steps
        for byte in piece:
            state, token = steps[state].get(byte) or self._step(state, byte)
            last.append(token)
        return self._back(last)


class Utf8Stream:
    """Text from chunks of bytes; a character that a chunk leaves open waits for the next one."""

    def __init__(self) -> None:
        self.open = b""

    def feed(self, chunk: bytes) -> str:
        chunk = self.open + chunk
        cut = len(chunk)
        for back in range(1, min(3, len(chunk)) + 1):
            lead = chunk[-back]
            if lead >= 0xC0:
                need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                if need > back:
                    cut = len(chunk) - back
                break
            if lead < 0x80:
                break
        self.open = chunk[cut:]
        return chunk[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """A vocabulary of ranks with its pattern: pieces to ids through the transducer, ids to bytes through a table."""

    def __init__(self, rank_file: str, pattern: str) -> None:
        self.ranks = read_ranks(rank_file)
        self.transducer = Transducer(self.ranks)
        self.pattern = regex.compile(pattern)
        size = max(self.ranks.values()) + 1
        self.width = np.zeros(size, np.int64)
        ordered = sorted((i, t) for t, i in self.ranks.items())
        for i, token in ordered:
            self.width[i] = len(token)
        self.flat = np.frombuffer(b"".join(t for _, t in ordered), np.uint8)
        self.begin = np.cumsum(self.width) - self.width
        self.cache = PieceCache(self.pieces)

    def encode_text(self, text: str) -> list[int]:
        ids: list[int] = []
        for match in self.pattern.findall(text):
            piece = match.encode()
            whole = self.ranks.get(piece)
            ids += self.transducer.encode(piece) if whole is None else (whole,)
        return ids

    def pieces(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that lie one after another, and how many each has."""
        flat, counts, at = array("I"), np.empty(len(sizes), np.int64), 0
        raw = data.tobytes()
        for i, size in enumerate(sizes.tolist()):
            ids = self.encode_text(raw[at : at + size].decode())
            flat.extend(ids)
            counts[i], at = len(ids), at + size
        return np.array(flat, np.uint32), counts

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        sizes = self.width[ids]
        total = np.cumsum(sizes)
        if not len(total):
            return b""
        return self.flat[np.repeat(self.begin[ids] - total + sizes, sizes) + np.arange(total[-1])].tobytes()

    def decode_stream(self, chunks: Iterable[np.ndarray]) -> Iterator[str]:
        """Text of ids that come in chunks, as soon as characters are whole."""
        stream = Utf8Stream()
        for ids in chunks:
            yield stream.feed(self.decode_bytes(ids))
        yield stream.close()


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(rank_file: str, pattern: str) -> Codec:
    """The codec of this process."""
    if (rank_file, pattern) not in _CODECS:
        _CODECS[rank_file, pattern] = Codec(rank_file, pattern)
    return _CODECS[rank_file, pattern]


def _walk(batch_column: pa.Array, using: Codec) -> Iterator[tuple[int, np.ndarray, bool]]:
    """``(row, ids, whether the row ends)`` in order; long rows come in several parts."""
    data, bounds = text_bytes(batch_column)
    pending: tuple[int, np.ndarray] | None = None
    for row, stop, ids, counts in encoded_segments(using.cache, data, bounds):
        cuts = np.append(0, np.cumsum(counts))
        for k in range(stop - row):
            if pending is not None:
                yield (*pending, pending[0] != row + k)
            pending = (row + k, ids[cuts[k] : cuts[k + 1]])
    if pending is not None:
        yield (*pending, True)


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of every row; for digests without the ids see :func:`round_trips`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using = codec(rank_file, pattern)
        for batch in (part for whole in batches for part in row_slices(whole, "text", SLICE_BYTES)):
            out, held = [], []
            for _, ids, over in _walk(batch.column("text"), using):
                held.append(ids)
                if over:
                    out.append(np.concatenate(held))
                    held = []
            lists = pa.ListArray.from_arrays(np.append(0, np.cumsum([len(x) for x in out])).astype(np.int32), np.concatenate([np.empty(0, np.uint32), *out]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return text_batches(rows).mapInArrow(run, "doc_id long, ids array<int>")


def round_trips(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text: ``doc_id, n_tokens, ids_sha256, decoded_sha256``, with bounded memory for long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using = codec(rank_file, pattern)
        for batch in (part for whole in batches for part in row_slices(whole, "text", SLICE_BYTES)):
            sizes, ids_hash, text_hash = [], [], []
            count, a, b, stream = 0, hashlib.sha256(), hashlib.sha256(), Utf8Stream()
            for _, ids, over in _walk(batch.column("text"), using):
                count += len(ids)
                a.update(ids.astype("<u4").tobytes())
                for k in range(0, len(ids), DECODE_STEP):
                    b.update(stream.feed(using.decode_bytes(ids[k : k + DECODE_STEP])).encode())
                if over:
                    b.update(stream.close().encode())
                    sizes.append(count), ids_hash.append(a.hexdigest()), text_hash.append(b.hexdigest())
                    count, a, b, stream = 0, hashlib.sha256(), hashlib.sha256(), Utf8Stream()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return text_batches(rows).mapInArrow(run, RESULT)
