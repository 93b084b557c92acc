"""Byte-level BPE as a bounded-lookahead streaming transducer.

Whether a token boundary stands can depend on what follows, but only as far
as chains of ever earlier merges reach.  :func:`lookahead` bounds that reach
from the merge list.  Texts are read piece by piece; within a long piece,
tokens that end further than the lookahead before the end of what has been
read are final and are emitted, and reading goes on from the last of them.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import sys
from array import array

import regex
from pyspark.sql import DataFrame, SparkSession

from .common import add_columns, kept_in_worker, read_table

TOKENIZER = "byte_bpe_50k.json"
#: Pieces whose tokens are remembered in a worker process, and their longest text.
REMEMBERED, LONGEST_REMEMBERED = 250_000, 48
#: Characters that are split into pieces at a time, and tokens that are decoded at a time.
_CHUNK, _TOKENS = 1 << 16, 1 << 15

# Fixed values of byte-level tokenizers: the split pattern and the printable stand-ins for bytes.
_SPACE = r"[\t-\r \x85\xa0  -     　]"
_OTHER = _SPACE.replace("[", "[^", 1)
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^\p{{L}}\p{{N}}{_SPACE[1:]}+|{_SPACE}+(?!{_OTHER})|{_SPACE}+"
#: A blank at which a piece begins whatever stands before: single, between two non-spaces.
_CUT = regex.compile(rf"(?<={_OTHER}) (?={_OTHER})")


def _stand_ins() -> dict[str, int]:
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def lookahead(merges: list[tuple[int, int, int]], sizes: list[int]) -> int:
    """Bytes after a token's end on which its standing can depend.

    ``merges``: (left, right, whole) token numbers in order of rank; ``sizes``:
    bytes by token.  A merge is undone from the right only by an earlier merge
    that takes a token on the right edge of its parts together with what
    follows; that one in turn only by a still earlier one, so the longest chain
    is found by going through the merges once in order.
    """
    right: dict[int, int] = {}
    reach: dict[int, int] = {}  # by left token: bytes its merges so far can look beyond it

    def beyond(token: int) -> int:
        most = 0
        while True:
            most = max(most, reach.get(token, 0))
            if token not in right:
                return most
            token = right[token]

    for left, second, whole in merges:
        far = sizes[second] + beyond(second)
        reach[left] = max(reach.get(left, 0), far)
        right.setdefault(whole, second)
    return max(map(beyond, range(len(sizes))), default=0)


class Tokenizer:
    """Encodes and decodes as the public tokenizers library does with a
    byte-level BPE file; strings of added tokens in a text are those tokens."""

    def __init__(self, definition: bytes):
        spec = json.loads(definition)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] \
                or model["dropout"] or model["ignore_merges"]:
            raise ValueError("only plain byte-level BPE files are supported")
        byte_of = _stand_ins()
        vocabulary = model["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: list[bytes] = [b""] * (1 + max([*vocabulary.values(), *added.values()]))
        for token, number in vocabulary.items():
            self.bytes_of[number] = bytes(byte_of[c] for c in token)
        for token, number in added.items():
            self.bytes_of[number] = token.encode()
        self.added = added
        self.added_split = regex.compile("(" + "|".join(
            map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.first = [0] * 256
        for number, token in enumerate(self.bytes_of):
            if len(token) == 1:
                self.first[token[0]] = number
        self.number = {token: n for n, token in enumerate(self.bytes_of) if n not in added.values()}
        self.longest = max(map(len, self.number))
        #: By token: the rank of the merge that makes it (-1: a byte) and its parts.
        self.made, self.parts = [-1] * len(self.bytes_of), [(0, 0)] * len(self.bytes_of)
        self.rank_of: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, second = pair if isinstance(pair, list) else pair.split(" ")
            whole = vocabulary[left + second]
            pair = vocabulary[left], vocabulary[second]
            self.rank_of[pair] = rank
            self.made[whole], self.parts[whole] = rank, pair
            self.merged.append(whole)
        merges = [(*pair, whole) for pair, whole in zip(self.rank_of, self.merged, strict=True)]
        self.checked: dict[int, bool] = {}
        self.neighbours: dict[tuple[int, int], bool] = {}
        self.lookahead = lookahead(merges, [len(b) for b in self.bytes_of])
        self.pieces = regex.compile(PATTERN)
        self.memory = _Memory(self)

    # -- encoding ---------------------------------------------------------
    def _stands(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` can be neighbours.  The merges along
        their common border are taken back, latest first; the border would
        have vanished if its two sides could have merged before one of them."""
        rank_of, made, parts = self.rank_of, self.made, self.parts
        limit = len(made)
        while True:
            if rank_of.get((a, b), limit) < limit:
                return False
            if made[a] > made[b]:
                limit, a = made[a], parts[a][1]
            elif made[b] >= 0:  # of equal merges the left one comes first
                limit, b = made[b] + 1, parts[b][0]
            else:
                return True

    def _whole(self, token: int) -> bool:
        """Whether the token's own bytes encode to it."""
        if token not in self.checked:
            ids, ranks = [self.first[b] for b in self.bytes_of[token]], self.rank_of
            while len(ids) > 1:
                rank, at = min((ranks.get(pair, len(self.made)), i) for i, pair in enumerate(zip(ids, ids[1:])))
                if rank == len(self.made):
                    break
                ids[at:at + 2] = [self.merged[rank]]
            self.checked[token] = ids == [token]
        return self.checked[token]

    def _encode(self, data: bytes) -> list[int]:
        """The one sequence of tokens of which all neighbours can stand: the
        longest next token that can, taken back where nothing can follow."""
        ids: list[int] = []
        starts: list[int] = []
        number, neighbours, longest = self.number, self.neighbours, self.longest
        stuck: set[int] = set()
        at, size = 0, len(data)
        end = min(size, longest)
        while at < size:
            while end > at:
                token = number.get(data[at:end])
                if token is not None and end not in stuck and self._whole(token):
                    if not ids:
                        break
                    pair = (ids[-1], token)
                    stands = neighbours.get(pair)
                    if stands is None:
                        if len(neighbours) >= REMEMBERED:
                            neighbours.clear()
                        stands = neighbours[pair] = self._stands(*pair)
                    if stands:
                        break
                end -= 1
            if end > at:
                ids.append(token)
                starts.append(at)
                at, end = end, min(size, end + longest)
            else:
                stuck.add(at)
                ids.pop()
                at, end = starts.pop(), at - 1
        return ids

    def stream(self, data: bytes, window: int | None = None):
        """Lists of token numbers of one piece, each emitted as soon as it is stable."""
        window = max(window or 0, 4 * self.lookahead, 1024)
        at, width = 0, window
        while at < len(data):
            end = min(len(data), at + width)
            ids = self._encode(data[at:end])
            if end < len(data):
                stable = at
                for n, token in enumerate(ids):
                    if stable + len(self.bytes_of[token]) > end - self.lookahead:
                        ids = ids[:n]
                        break
                    stable += len(self.bytes_of[token])
                if stable == at:  # one token longer than the window
                    width *= 2
                    continue
                at = stable
            else:
                at = end
            width = window
            yield ids

    def packed(self, piece: str) -> bytes:
        """A piece's token numbers as little-endian 32-bit integers."""
        return b"".join(_pack(ids) for ids in self.stream(piece.encode()))

    def encode(self, text: str):
        """Token numbers of a whole text, packed, a stretch of text at a time."""
        parts = self.added_split.split(text) if self.added_split and self.added_split.search(text) else [text]
        for part in parts:
            if part in self.added:
                yield _pack([self.added[part]])
                continue
            at = 0
            while at < len(part):
                end = len(part)
                if end - at > _CHUNK:
                    cut = _CUT.search(part, at + _CHUNK)
                    end = cut.start() if cut else end
                if end - at <= 2 * _CHUNK:
                    yield b"".join(map(self.memory.__getitem__, self.pieces.findall(part, at, end)))
                else:
                    for piece in self.pieces.finditer(part, at, end):
                        yield self.memory[piece.group()]
                at = end

    # -- decoding ---------------------------------------------------------
    def decode(self, packed):
        """Texts of packed token numbers, fed a stretch at a time to a UTF-8
        state machine that holds back unfinished characters; bytes that are no
        UTF-8 become replacement characters."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        look = self.bytes_of.__getitem__
        for part in packed:
            for start in range(0, len(part), 4 * _TOKENS):
                numbers = array("I", part[start:start + 4 * _TOKENS])
                yield machine.decode(b"".join(map(look, numbers)))
        yield machine.decode(b"", final=True)


class _Memory(dict):
    """Packed tokens by piece; short pieces are remembered."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, piece: str) -> bytes:
        packed = self.tokenizer.packed(piece)
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed


def _pack(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder != "little":
        packed.byteswap()
    return packed.tobytes()


def _tokenizer(definition: bytes) -> Tokenizer:
    """One tokenizer is kept in each worker process."""
    return kept_in_worker(("bpe", hashlib.sha256(definition).digest()), lambda: Tokenizer(definition))


#: What :func:`encode_texts` can return, with types.
OUTPUTS = {"ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded": "string",
           "decoded_sha256": "string"}


def _make(definition, outputs):
    tokenizer = _tokenizer(definition.value)
    whole_ids, decodes, whole_text = "ids" in outputs, any(o.startswith("decoded") for o in outputs), "decoded" in outputs

    def compute(text):
        count, digest, again = 0, hashlib.sha256(), hashlib.sha256()
        ids, texts = array("I"), []

        def encoded():
            nonlocal count
            for packed in tokenizer.encode(text or ""):
                count += len(packed) // 4
                digest.update(packed)
                if whole_ids:
                    ids.frombytes(packed)
                yield packed

        if decodes:
            for piece in tokenizer.decode(encoded()):
                again.update(piece.encode())
                if whole_text:
                    texts.append(piece)
        else:
            for _ in encoded():
                pass
        values = {"ids": ids.tolist(), "n_tokens": count, "ids_sha256": digest.hexdigest(),
                  "decoded": "".join(texts), "decoded_sha256": again.hexdigest()}
        return tuple(values[o] for o in outputs)

    return compute


def encode_texts(docs: DataFrame, path: str, outputs=tuple(OUTPUTS)) -> DataFrame:
    """``docs`` with the columns named in ``outputs`` (see :data:`OUTPUTS`):
    the token numbers of ``text``, their count and SHA-256 (as little-endian
    32-bit integers), the text decoded from them again and its SHA-256 (UTF-8).

    ``path``: a byte-level BPE file of the tokenizers library on the driver; it
    (a few MB) is broadcast.  Null texts count as empty.  Rows pass as they
    are; columns of ``docs`` named like a new one are replaced.  No shuffle.
    """
    with open(path, "rb") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    return add_columns(docs, ["text"], ", ".join(f"{o} {OUTPUTS[o]}" for o in outputs), _make, definition,
                       tuple(outputs))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, default_path(), ("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


QUERIES = {"op10_bpe": op10_bpe}
ORACLES: dict[str, str] = {}
