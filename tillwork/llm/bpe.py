"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

Merging pairs by rank has an equivalent left-to-right form: a sequence of tokens is the encoding of
its bytes exactly if each token is what merging makes of its own bytes, and each neighbouring pair is
what merging makes of the pair's bytes. That makes a nondeterministic transducer: a hypothesis is the
place in the trie of tokens where the current token has got to, behind the tokens before it. The
subset construction runs while text is read and keeps the states and transitions it has met twice (a
rare ending is followed without new states). Each step emits the tokens that all hypotheses share; as
two hypotheses differ by less than a longest token of input, that lookahead is bounded.

Encoding runs per row; nothing is shuffled. Only the vocabulary file is broadcast, which has a fixed
size.

Defined cases: a null text is encoded as an empty one, to no ids; null ids decode to no bytes. Ids
that are not in the vocabulary are an error. Bytes that are not UTF-8 decode to replacement
characters, in the text only. Other columns pass through, whatever their names; a column of the
result's name is replaced. Long texts are cut into chunks between tokens of the pattern, so that the
lists made while encoding stay small.
"""

from __future__ import annotations

import codecs
import hashlib
from array import array
from base64 import b64decode
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import bounded_batches, read_table, set_aside
from tillwork.llm.registry import query

CHUNK_CHARS = 1 << 18
#: Entries after which a cache is emptied: bounds a worker's memory, not what is encoded.
CACHED_PIECES = 1 << 18
CACHED_STEPS = 1 << 19
#: Pieces from so many bytes on are determinised at once: the tokens pending stay few.
FAR = 64
#: Above every rank.
NEVER = 1 << 62


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The tokens of a rank file: a line has the token in base 64 and its rank."""
    return {b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Transducer:
    """Turns the bytes of one piece of text into ids, a byte at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self._ranks = ranks
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._child: dict[int, int] = {}  # (node << 8 | byte) -> node
        self._token: list[int] = [-1]  # by node; -1 where no token ends
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                edge = node << 8 | byte
                if edge not in self._child:
                    self._child[edge] = len(self._token)
                    self._token.append(-1)
                node = self._child[edge]
            self._token[node] = rank
        self._inner = {edge >> 8 for edge in self._child}
        self._built: dict[int, tuple[list, list] | None] = {}
        self._follows: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        start = ((0, (), -1),)
        self._states = [start]
        self._ids = {start: 0}
        self._steps: dict[int, int] = {}  # (state << 8 | byte) -> state
        self._emits: dict[int, tuple[int, ...]] = {}  # of steps that decide tokens
        self._met: set[int] = set()  # steps seen once

    def _edges(self, token: int) -> tuple[list, list] | None:
        """What the token's first and last part are while merging builds it: (bytes, rank of the
        merge that ends the part) from a single byte up to the token; None if merging never does."""
        known = self._built.get(token, self)
        if known is not self:
            return known
        parts = [self._bytes[token][i : i + 1] for i in range(len(self._bytes[token]))]
        first, last = [parts[0]], [parts[-1]]
        while len(parts) > 1:
            best, i = min(
                ((self._ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))),
            )
            if best == NEVER:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if i == 0:
                first.append(parts[0])
            if i == len(parts) - 1:
                last.append(parts[-1])
        spines = None
        if len(parts) == 1:
            spines = tuple(
                list(zip(spine, [self._ranks[p] for p in spine[1:]] + [NEVER])) for spine in (first, last)
            )
        self._built[token] = spines
        return spines

    def _may_follow(self, last: int, token: int) -> bool:
        """Whether merging makes ``token`` at all and never merges across its border with ``last``.

        Merges come in order of rank, on both sides of the border at once; one across it wins if its
        rank is below that of the next merge on the left, and not above that of the next on the right.
        """
        ours = self._edges(token)
        if last < 0 or ours is None:
            return ours is not None
        key = last << 32 | token
        follows = self._follows.get(key)
        if follows is None:
            if len(self._follows) >= CACHED_STEPS:
                self._follows.clear()
            left, right = self._edges(last)[1], ours[0]
            i = j = 0
            while True:
                (x, end_x), (y, end_y) = left[i], right[j]
                across = self._ranks.get(x + y, NEVER)
                if across < end_x and across <= end_y and across != NEVER:
                    follows = False
                elif end_x == end_y == NEVER:
                    follows = True
                elif end_x <= end_y:
                    i += 1
                    continue
                else:
                    j += 1
                    continue
                break
            self._follows[key] = follows
        return follows

    def _next(self, hypotheses, byte: int) -> list[tuple[int, tuple[int, ...], int]]:
        """The hypotheses after one more byte. One of them ends there, and comes last."""
        ahead, whole = [], None
        child, tokens, inner, follows = self._child, self._token, self._inner, self._follows
        for node, pending, last in hypotheses:
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            if node in inner:
                ahead.append((node, pending, last))
            token = tokens[node]
            if token >= 0:
                follow = follows.get(last << 32 | token)
                if self._may_follow(last, token) if follow is None else follow:
                    whole = (0, (*pending, token), token)
        ahead.append(whole)
        return ahead

    def _determinise(self, edge: int) -> int:
        """The state that a state reaches with a byte; tokens that all hypotheses share are emitted."""
        ahead = self._next(self._states[edge >> 8], edge & 255)
        first = ahead[0][1]
        if first:
            n = len(first)
            for _, pending, _ in ahead:
                while first[:n] != pending[:n]:
                    n -= 1
            if n:
                self._emits[edge] = first[:n]
                ahead = [(node, pending[n:], last) for node, pending, last in ahead]
        key = tuple(ahead)
        state = self._ids.setdefault(key, len(self._states))
        if state == len(self._states):
            self._states.append(key)
        self._steps[edge] = state
        return state

    def _follow(self, data: bytes) -> list[int]:
        """The way of the one hypothesis that lasts, through a short piece, without states: the token
        that ends at each place, from those that end before."""
        child, tokens, follows = self._child, self._token, self._follows
        size = len(data)
        ends = [-1] * (size + 1)
        for begin in range(size):
            last, node = ends[begin], 0
            for end in range(begin, size):
                node = child.get(node << 8 | data[end])
                if node is None:
                    break
                token = tokens[node]
                if token >= 0 and ends[end + 1] < 0:
                    follow = follows.get(last << 32 | token)
                    if self._may_follow(last, token) if follow is None else follow:
                        ends[end + 1] = token
        ids = []
        while size:
            ids.append(ends[size])
            size -= len(self._bytes[ends[size]])
        return ids[::-1]

    def encode(self, data: bytes) -> list[int]:
        if len(self._steps) >= CACHED_STEPS or len(self._met) >= 2 * CACHED_STEPS:
            self._forget()
        steps, emits, met = self._steps, self._emits, self._met
        ids: list[int] = []
        state = 0
        for at, byte in enumerate(data):
            edge = state << 8 | byte
            state = steps.get(edge)
            if state is None:
                # A step is determinised when it is met again, and in long pieces at once.
                if edge not in met and len(data) < FAR:
                    met.add(edge)
                    return self._follow(data)
                state = self._determinise(edge)
            if edge in emits:
                ids += emits[edge]
        ids += self._states[state][-1][1]
        return ids


class Encoder:
    """Texts to ids: pieces by the pattern, each a token as it is or else through the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._pattern = regex.compile(pattern)
        self._gap = regex.compile(r"(?<=\S)\s")
        transducer = Transducer(ranks)

        class Pieces(dict):
            def __missing__(self, piece: str) -> tuple[int, ...]:
                data = piece.encode()
                rank = ranks.get(data)
                ids = tuple(transducer.encode(data)) if rank is None else (rank,)
                if len(self) >= CACHED_PIECES:
                    self.clear()
                self[piece] = ids
                return ids

        self._pieces = Pieces()

    def _chunks(self, text: str) -> Iterator[str]:
        """Cuts where white space follows other text: no piece of the pattern reaches across."""
        start = 0
        while len(text) - start > CHUNK_CHARS:
            gap = self._gap.search(text, start + CHUNK_CHARS)
            if gap is None:
                break
            yield text[start : gap.start()]
            start = gap.start()
        yield text[start:] if start else text

    def encode(self, text: str) -> array:
        ids = array("I")
        for chunk in self._chunks(text):
            ids.extend(chain.from_iterable(map(self._pieces.__getitem__, self._pattern.findall(chunk))))
        return ids


class StreamDecoder:
    """Ids to text as they arrive: an incremental UTF-8 state machine holds back the bytes of a
    character that later ids complete."""

    def __init__(self, tokens: dict[int, bytes], errors: str = "replace"):
        self._tokens = tokens
        self._machine = codecs.getincrementaldecoder("utf-8")(errors)

    def feed(self, ids: Iterable[int]) -> tuple[bytes, str]:
        data = b"".join(map(self._tokens.__getitem__, ids))
        return data, self._machine.decode(data)

    def finish(self) -> str:
        return self._machine.decode(b"", True)


@cache
def _encoder(digest: str, vocabulary) -> Encoder:
    return Encoder(read_ranks(vocabulary.data), vocabulary.pattern)


@cache
def _tokens(digest: str, vocabulary) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(vocabulary.data).items()}


class Vocabulary:
    """A rank file's bytes, broadcast, with the pattern; equal files share a worker's tables."""

    def __init__(self, spark, data: bytes, pattern: str):
        self._data = spark.sparkContext.broadcast(data)
        self.pattern = pattern
        self.digest = hashlib.sha256(data + pattern.encode()).hexdigest()

    @property
    def data(self) -> bytes:
        return self._data.value

    def __eq__(self, other) -> bool:
        return self.digest == other.digest

    def __hash__(self) -> int:
        return hash(self.digest)


def public_vocabulary(spark, name: str = "byte_bpe_multi_50k.tiktoken") -> Vocabulary:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return Vocabulary(spark, file.read(), public_tokenizers.PATTERN)


def _encoded(vocabulary: Vocabulary, texts: pa.Array) -> list[bytes]:
    encoder = _encoder(vocabulary.digest, vocabulary)
    return [_little(encoder.encode(text.as_py() or "")) for text in texts]


def _decoded(vocabulary: Vocabulary, columns: Iterable[bytes | None]) -> tuple[list[bytes], list[int]]:
    """The bytes of each row's ids, and the number of characters that streaming them gives."""
    tokens = _tokens(vocabulary.digest, vocabulary)
    decoded, chars = [], []
    for value in columns:
        parts, n, machine = [], 0, StreamDecoder(tokens)
        ids = array("I")
        ids.frombytes(value or b"")
        for start in range(0, len(ids), CHUNK_CHARS):
            data, text = machine.feed(ids[start : start + CHUNK_CHARS])
            parts.append(data)
            n += len(text)
        decoded.append(b"".join(parts))
        chars.append(n + len(machine.finish()))
    return decoded, chars


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids``: little-endian unsigned 32-bit integers, as binary."""

    @F.arrow_udf("binary")
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(_encoded(vocabulary, batch), pa.binary())

    bounded_batches(docs.sparkSession)
    return docs.withColumn("token_ids", encode(F.col(text).cast("string")))


def decode_documents(docs: DataFrame, vocabulary: Vocabulary, ids: str = "token_ids") -> DataFrame:
    """``docs`` with ``decoded``: the bytes of the ids, and ``decoded_chars``: the characters that
    streaming them gives."""

    @F.arrow_udf("struct<decoded:binary,chars:long>")
    def decode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in columns:
            decoded, chars = _decoded(vocabulary, batch.to_pylist())
            yield pa.StructArray.from_arrays(
                [pa.array(decoded, pa.binary()), pa.array(chars, pa.int64())], ["decoded", "chars"]
            )

    bounded_batches(docs.sparkSession)
    docs, columns = set_aside(docs, "_decoded")
    made = {"decoded": F.col("_decoded.decoded"), "decoded_chars": F.col("_decoded.chars")}
    out = docs.withColumn("_decoded", decode(F.col(ids))).withColumns(made)
    return out.select(*columns, *(c for c in made if c not in docs.columns))


def _little(ids: array) -> bytes:
    if ids.itemsize != 4:
        raise ValueError("ids need four bytes")
    return ids.tobytes()


def token_digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per document the number of tokens and digests of the ids and of what they decode to.

    Both directions run in one Python pass, which halves the workers."""

    @F.arrow_udf("struct<ids:binary,decoded:binary,chars:long>")
    def code(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            ids = _encoded(vocabulary, batch)
            decoded, chars = _decoded(vocabulary, ids)
            columns = [pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())]
            yield pa.StructArray.from_arrays(
                [*columns, pa.array(chars, pa.int64())], ["ids", "decoded", "chars"]
            )

    bounded_batches(docs.sparkSession)
    coded = docs.select("doc_id", code(F.col("text").cast("string")).alias("code"))
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("code.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("code.ids", 256).alias("ids_sha256"),
        F.sha2("code.decoded", 256).alias("decoded_sha256"),
        F.col("code.chars").alias("decoded_chars"),
    )


@query()
def op5_bpe(spark, sf_dir):
    """Every document through encoding and decoding."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_digests(docs, public_vocabulary(spark))
