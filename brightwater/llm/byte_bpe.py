"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

A token sequence is the encoding of its bytes exactly if every two neighbours are: no merge across their border comes
before those that complete them. So the merges compile into a transducer that reads bytes, keeps a hypothesis for
every token that may be under way, and accepts a token where it agrees with the one before. One hypothesis at most
ends at any byte, so each byte has one token at most that ends there. Determinising makes each set of hypotheses one
state, made, like its transitions, when first met. The tokens are emitted backwards from where all hypotheses agree:
a piece's end, or in long pieces the last such place before each 4096 bytes.

Pieces of the split pattern are encoded apart. Between many kinds of neighbouring bytes, as a letter and a comma, the
pattern always has a border, so texts are taken apart there first, all at once; only distinct chunks go through the
transducer, and their ids are gathered for all places.

Defined cases: a null text has no bytes and no tokens, like an empty one; texts of any length are encoded whole;
repeated rows are encoded alike; an empty table gives an empty result; other columns pass through unchanged, whatever
their names; only a column named like one that the operator adds is refused with a ValueError.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater.llm import common

#: Chunks, and transitions and pairs of tokens, that a worker keeps at most.
CACHE, MOVES = 200_000, 200_000
#: Bytes of a chunk's ids from which on it isn't kept; ids that are turned into bytes or text at once.
KEPT_BYTES, BLOCK = 256, 1 << 20
#: Bytes of texts whose chunks are looked up at once.
SLICE = 2 << 20
TOKENS = pa.struct([("n", pa.int64()), ("ids", pa.list_(pa.int32())), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
#: Fixed value: the split pattern for which a blank and letters are known to be one piece.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
HYPOTHESES, NONE = -1, -1
#: Bytes of a piece after which settled tokens are emitted.
LOOKAHEAD = 4096


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Transducer:
    """Tokens of a piece of bytes, by the ranks of their merges.

    A hypothesis is a number: of a token that may be under way the place in the trie of all tokens, and the token before
    it. A state is a dict: byte to (next state, token that ends with this byte or NONE), and HYPOTHESES.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, {v: k for k, v in ranks.items()}
        self.length = {v: len(k) for k, v in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token, self.depth = [NONE], [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                to = self.children[node].get(byte)
                if to is None:
                    to = self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token.append(NONE)
                    self.depth.append(self.depth[node] + 1)
                node = to
            self.token[node] = rank
        self.nodes = len(self.children)
        self._edges: dict[tuple[int, int], list] = {}
        self._agree: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        begin = ((max(self.tokens, default=0) + 1) * self.nodes,)  # no token before, at the trie's root
        self.start, self.moves = {HYPOTHESES: begin}, 0
        self.states = {begin: self.start}

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge completes this one."""
        parts = [bytes([b]) for b in self.tokens[token]]
        if len(parts) == 1:
            return None
        while len(parts) > 2:
            _, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """What stands at the token's left (0) or right (1) edge in the course of its merges: (bytes, rank of the merge that takes it in)."""
        found = self._edges.get((token, side))
        if found is None:
            own, until, found = token, 1 << 40, []
            while True:
                found.append((self.tokens[own], until))
                halves = self._halves(own)
                if halves is None:
                    break
                own, until = halves[side], own
            self._edges[token, side] = found
        return found

    def agree(self, a: int, b: int) -> bool:
        """Whether the tokens can stand side by side: no merge over their border comes in time."""
        key = a * self.nodes + b
        found = self._agree.get(key)
        if found is None:
            # Of equal merges the leftmost goes first.
            found = not any(
                (rank := self.ranks.get(x + y)) is not None and rank < x_until and rank <= y_until for x, x_until in self._edge(a, 1) for y, y_until in self._edge(b, 0)
            )
            if len(self._agree) >= MOVES:
                self._agree.clear()
            self._agree[key] = found
        return found

    def _move(self, state: dict, byte: int) -> tuple[dict, int]:
        after, whole, nodes, none = [], NONE, self.nodes, self.start[HYPOTHESES][0]
        for hypothesis in state[HYPOTHESES]:
            node = self.children[hypothesis % nodes].get(byte)
            if node is None:
                continue
            last = hypothesis - hypothesis % nodes
            if self.children[node]:
                after.append(last + node)
            token = self.token[node]
            if token != NONE and whole == NONE and (last == none or self.agree(last // nodes, token)):
                whole = token
        if whole != NONE:
            after.append(whole * nodes)
        hypotheses = tuple(after)
        to = self.states.get(hypotheses)
        if to is None:
            to = self.states[hypotheses] = {HYPOTHESES: hypotheses}
        self.moves += 1
        move = state[byte] = (to, whole)
        return move

    def _back(self, ends: list[int], until: int) -> list[int]:
        """The tokens before place ``until``, of the one that ends at each place."""
        out = []
        while until:
            out.append(token := ends[until - 1])
            if token == NONE:
                raise ValueError("bytes that have no token")
            until -= self.length[token]
        out.reverse()
        return out

    def _settled(self, ends: list[int], state: dict) -> int:
        """The place up to which all hypotheses have the same tokens."""
        places = {len(ends) - self.depth[h % self.nodes] for h in state[HYPOTHESES]}
        while len(places) > 1:
            places.remove(last := max(places))
            if ends[last - 1] != NONE:
                places.add(last - self.length[ends[last - 1]])
        return min(places, default=0)

    def encode(self, piece: bytes) -> list[int]:
        if self.moves >= MOVES:
            self._reset()
        if len(piece) > LOOKAHEAD:
            return self._long(piece)
        state, ends = self.start, []
        for byte in piece:
            try:
                state, token = state[byte]
            except KeyError:
                state, token = self._move(state, byte)
            ends.append(token)
        return self._back(ends, len(ends))

    def _long(self, piece: bytes) -> list[int]:
        """Emits what all hypotheses agree on after each LOOKAHEAD bytes, so no more than that is held."""
        state, ends, out = self.start, [], []
        for i, byte in enumerate(piece):
            state, token = state.get(byte) or self._move(state, byte)
            ends.append(token)
            if i % LOOKAHEAD == LOOKAHEAD - 1:
                place = self._settled(ends, state)
                out += self._back(ends, place)
                del ends[:place]
        return out + self._back(ends, len(ends))


#: Kinds of bytes in the split pattern's terms; what isn't certain from one byte is OTHER.
LETTER, DIGIT, BLANK, SPACE, MARK, QUOTE, OTHER = range(7)


def _kinds() -> np.ndarray:
    kind = np.full(256, OTHER, np.uint8)
    kind[:28] = kind[32:128] = MARK
    kind[[*range(65, 91), *range(97, 123)]] = LETTER
    kind[48:58] = DIGIT
    kind[9:14] = SPACE
    kind[32], kind[39] = BLANK, QUOTE
    return kind


def _cuts() -> np.ndarray:
    """For two neighbouring kinds (first times 7, and second) whether the pattern always has a border between them."""
    ends = {
        LETTER: (DIGIT, BLANK, SPACE, MARK, QUOTE),
        DIGIT: (LETTER, BLANK, SPACE, MARK, QUOTE),
        SPACE: (LETTER, DIGIT, MARK, QUOTE),
        MARK: (LETTER, DIGIT, BLANK, SPACE),
        QUOTE: (DIGIT, BLANK, SPACE),  # a letter may belong to a contraction
    }
    out = np.zeros(49, bool)
    for first, seconds in ends.items():
        out[[first * 7 + second for second in seconds]] = True
    return out


_KIND, _CUT = _kinds(), _cuts()


def chunk_starts(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where chunks of texts (bytes, and their offsets) begin: only where SPLIT_PATTERN has a border for certain.

    Of white space before another character the last one begins a piece of its own or with what follows, so there is a
    border before it too; with it, each chunk's pieces are the same as in the whole text.
    """
    n = len(body)
    kind = _KIND[body]
    border = np.zeros(n + 1, bool)
    border[1:n] = _CUT[kind[:-1] * np.uint8(7) + kind[1:]]
    white, solid = (kind == BLANK) | (kind == SPACE), (kind <= DIGIT) | (kind == MARK) | (kind == QUOTE)
    before = white[:-1] & solid[1:]
    inner = at[1:-1]
    before[inner[(inner > 0) & (inner < n)] - 1] = False  # what follows there is another text
    border[: n - 1] |= before
    border[at] = True
    return np.flatnonzero(border[:n])


class Encoder:
    """Tokens of texts, and texts of tokens, for whole Arrow arrays at a time.

    Texts are taken apart into chunks, of which an array's distinct ones are found first: only these are encoded, and of
    them only those that aren't kept. What is kept is bounded: chunks that come when the table is full aren't, and if
    under half of an array's distinct chunks are found, the table starts over.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, keep: int | None = None):
        import regex

        self.transducer, self.most = Transducer(ranks), keep or CACHE
        self.pieces, self.known_pattern = regex.compile(pattern).findall, pattern == SPLIT_PATTERN
        bytes_of = [self.transducer.tokens.get(i, b"") for i in range(max(self.transducer.tokens, default=-1) + 1)]
        self.bytes_of = pa.array(bytes_of, pa.large_binary())
        self.text_of = pa.array([b"%d," % i for i in range(len(bytes_of))], pa.large_binary())
        self.kept: dict[str, bytes] = {}

    def _encode(self, chunk: str) -> bytes:
        encode = self.transducer.encode
        if self.known_pattern and (chunk[1:] if chunk[0] == " " else chunk).isalpha():  # a blank and letters are one piece
            found = encode(chunk.encode())
        else:
            found = []
            for piece in self.pieces(chunk):
                found += encode(piece.encode())
        return array("i", found).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and their n + 1 offsets; null is empty."""
        body, at = common.utf8(texts)
        if not len(body):
            return np.empty(0, np.int32), np.zeros(len(at), np.int64)
        starts = chunk_starts(body, at) if self.known_pattern else np.unique(at[:-1][at[:-1] < at[1:]])
        offsets = np.append(starts, len(body))
        chunks = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(body)).dictionary_encode()
        distinct, codes = chunks.dictionary.to_pylist(), chunks.indices.to_numpy()
        found = list(map(self.kept.get, distinct))
        new = [i for i, ids in enumerate(found) if ids is None]
        if 2 * len(new) > len(found) and len(self.kept) >= self.most:
            self.kept.clear()
        room = self.most - len(self.kept) if self.known_pattern else 0
        for i in new:
            ids = found[i] = self._encode(distinct[i])
            if room > 0 and len(ids) <= KEPT_BYTES:
                self.kept[distinct[i]] = ids
                room -= 1
        pool = np.frombuffer(b"".join(found), np.int32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(sizes) - sizes
        ends = np.cumsum(sizes[codes])
        shift = begin[codes]
        shift[1:] -= ends[:-1]
        ids = pool[np.repeat(shift, sizes[codes]) + np.arange(ends[-1])]
        return ids, np.append(0, ends)[np.searchsorted(starts, at)]

    def parts(self, of: pa.Array, ids: np.ndarray, first: np.ndarray) -> Iterator[list[memoryview]]:
        """For each text the bytes that ``of`` has for its ids, in parts of BLOCK ids at most."""
        i = 0
        while i < len(first) - 1:
            j = max(i + 1, int(np.searchsorted(first, first[i] + BLOCK, "right")) - 1)
            if j == i + 1:
                yield (common.packed_bytes(of.take(pa.array(ids[k : min(k + BLOCK, first[j])])))[0] for k in range(int(first[i]), int(first[j]), BLOCK))
            else:
                data, at = common.packed_bytes(of.take(pa.array(ids[first[i] : first[j]])))
                for a, b in zip(at[first[i:j] - first[i]].tolist(), at[first[i + 1 : j + 1] - first[i]].tolist(), strict=True):
                    yield (data[a:b],) if b > a else ()
            i = j


class Utf8Machine:
    """The incremental UTF-8 state machine: what of a byte stream is whole code points, and what has to wait."""

    #: State after a lead byte: continuation bytes that are due, and the range of the first of them.
    @staticmethod
    def _lead(byte: int) -> tuple[int, int, int]:
        if byte < 0x80:
            return 0, 0, 0
        if 0xC2 <= byte <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= byte <= 0xEF:
            return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
        if 0xF0 <= byte <= 0xF4:
            return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
        return 0, 0, 0  # no lead byte: an error that needs nothing more

    @classmethod
    def waiting(cls, data: bytes) -> int:
        """How many bytes at the end begin a code point that isn't complete; three at most decide."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if 0x80 <= byte <= 0xBF:
                continue
            due, low, high = cls._lead(byte)
            if due < back or (back > 1 and not low <= data[-back + 1] <= high):
                return 0
            return back
        return 0


class StreamDecoder:
    """Text of token bytes that come in parts; a code point that is cut between parts waits for its rest."""

    def __init__(self) -> None:
        self.rest = b""

    def feed(self, part) -> str:
        data = self.rest + bytes(part)
        n = len(data) - Utf8Machine.waiting(data)
        self.rest = data[n:]
        return data[:n].decode("utf-8", "replace")

    def close(self) -> str:
        out, self.rest = self.rest.decode("utf-8", "replace"), b""
        return out


def decoded(parts) -> Iterator[str]:
    """The text of a stream of token bytes, in parts."""
    decoder = StreamDecoder()
    for part in parts:
        yield decoder.feed(part)
    yield decoder.close()


_encoders: dict[tuple, Encoder] = {}
common.TABLES["byte_bpe"] = _encoders.clear


def encoder(path: str, pattern: str, keep: int | None = None) -> Encoder:
    """This process's encoder for a rank file, made once."""
    if (path, pattern, keep) not in _encoders:
        gc.set_threshold(200_000, 20, 100)  # its tables have no cycles, and looking for some is dear
        _encoders[path, pattern, keep] = Encoder(load_ranks(path), pattern, keep)
    return _encoders[path, pattern, keep]


def _listed(parts) -> str:
    """The digest of ids as text; each comes with a comma behind it, of which the last doesn't count."""
    digest, last = hashlib.sha256(), b""
    for part in parts:
        digest.update(last)
        digest.update(part[:-1])
        last = b","
    return digest.hexdigest()


def _digest(parts) -> str:
    digest = hashlib.sha256()
    for text in decoded(parts):
        digest.update(text.encode())
    return digest.hexdigest()


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: bool = True, keep: int | None = None) -> DataFrame:
    """docs with __n_tokens, __ids_sha256, __decoded_sha256 and, if asked for, __ids; what is decoded comes from the ids.

    keep: chunks that a worker holds at most (CACHE by default), where memory is short.
    """
    common.prepare(docs.sparkSession)
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("struct<n: long, ids: array<int>, ids_sha256: string, decoded_sha256: string>")
    def tokens(texts: pa.Array) -> pa.Array:
        common.owner("byte_bpe")
        own, out = encoder(path, pattern, keep), []
        for part in common.slices(texts, SLICE):
            found, first = own.encode(part)
            lists = pa.ListArray.from_arrays(pa.array(first if ids else np.zeros(len(first), np.int64), pa.int32()), pa.array(found if ids else found[:0]))
            digests = [pa.array(list(map(f, own.parts(of, found, first))), pa.string()) for f, of in ((_listed, own.text_of), (_digest, own.bytes_of))]
            out.append(pa.StructArray.from_arrays([pa.array(np.diff(first)), lists, *digests], ["n", "ids", "ids_sha256", "decoded_sha256"]))
        return pa.concat_arrays(out) if out else pa.array([], TOKENS)

    common.refuse(docs, "__tokens", "__n_tokens", "__ids_sha256", "__decoded_sha256", "__ids")
    new = {"__n_tokens": "n", "__ids_sha256": "ids_sha256", "__decoded_sha256": "decoded_sha256"} | ({"__ids": "ids"} if ids else {})
    return docs.withColumn("__tokens", tokens(F.col(f"`{text}`"))).select(*(F.col(f"`{c}`") for c in docs.columns), *(F.col("__tokens")[v].alias(k) for k, v in new.items()))


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """rows with __text, the text of their token ids; null for null, and for an empty list the empty text."""
    common.prepare(rows.sparkSession)
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        common.owner("byte_bpe")
        own, none = encoder(path, pattern), lists.is_null().to_pylist()
        flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy()
        parts = own.parts(own.bytes_of, flat, np.append(0, np.cumsum(sizes, dtype=np.int64)))
        return pa.array([None if null else "".join(decoded(x)) for null, x in zip(none, parts, strict=True)], pa.string())

    return rows.withColumn("__text", texts(F.col(f"`{ids}`")))


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def query(spark, sf_dir: str) -> DataFrame:
    """One row for each document: its tokens' number and digest, and the digest of what they decode to."""
    common.prepare(spark)
    out = encode(common.table(spark, sf_dir, "documents").select("doc_id", "text"), *vocabulary(), ids=False)
    return out.select("doc_id", F.col("__n_tokens").alias("n_tokens"), F.col("__ids_sha256").alias("ids_sha256"), F.col("__decoded_sha256").alias("decoded_sha256"))
