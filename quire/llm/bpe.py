"""Operator 8: BPE encoding by backtracking over longest token matches, decoding by offsets.

An Aho-Corasick automaton finds, in one pass over a word, every vocabulary token in it; the longest
one at each position is the first choice there. A choice stands only if it is compatible with the
token before it: undoing the merges on both sides of their border must never meet a pair that BPE
would have merged across it. Otherwise the next shorter token is tried, and a position from which
nothing fits is never entered again. The result is exactly the merge order's, in time linear in the
word. Compatibility is a table, filled as pairs are met. Decoding gathers token bytes from one
buffer through an offset table.

Defined results: null text is empty text, an empty text has no tokens, special-token strings in a
text become their ids (as the tokenizers library does by default). Rows are independent: repeated
rows, null keys and further columns do not matter.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
import unicodedata
from collections import OrderedDict

import ahocorasick
import numpy as np
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, texts_of

#: Words kept encoded in a task; beyond that the oldest go (a word seen again is encoded anew).
CACHE_WORDS = 400_000
END = 256  # a byte that ends a word is the symbol byte + END


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + extra)
            extra += 1
    return [table[b] for b in range(256)]


class WordBpe:
    """Encoder and decoder of a word-end BPE vocabulary (a ``tokenizers`` JSON file)."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        definition = json.loads(spec)
        model = definition["model"]
        self.suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        symbol = byte_symbols()
        as_byte = {c: b for b, c in enumerate(symbol)}
        #: a word is a string of code points below 512: bytes, the last one plus END
        self.ids: dict[str, int] = {}
        raw: dict[int, bytes] = {}
        for text, number in vocab.items():
            ends = text.endswith(self.suffix)
            body = text[: -len(self.suffix)] if ends else text
            values = [as_byte[c] for c in body]
            raw[number] = text.encode()
            if ends:
                values[-1] += END
            self.ids["".join(map(chr, values))] = number
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        n = max(vocab.values()) + 1
        self.rank = np.full(n, -1, np.int64)  # merge rank that makes a token; -1: a symbol
        self.left, self.right = list(range(n)), list(range(n))
        self.made: dict[tuple[int, int], int] = {}
        for position, (a, b) in enumerate(merges):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.made[x, y] = z
            if self.rank[z] < 0:
                self.rank[z], self.left[z], self.right[z] = position, x, y
        self.rank = self.rank.tolist()
        self.machine = ahocorasick.Automaton()
        for word, number in self.ids.items():
            self.machine.add_word(word, (len(word), number))
        self.machine.make_automaton()
        self.length = [0] * n
        self.shorter = [-1] * n  # the longest token that is a proper prefix of this one
        for word, number in self.ids.items():
            self.length[number] = len(word)
            for k in range(len(word) - 1, 0, -1):
                if (known := self.ids.get(word[:k])) is not None:
                    self.shorter[number] = known
                    break
        self.compatible: dict[tuple[int, int], bool] = {}
        self.symbols = [[self.ids[chr(b)], self.ids[chr(b + END)]] for b in range(256)]
        self.words: OrderedDict[str, bytes] = OrderedDict()
        # special tokens: found in the raw text before anything else
        self.special = {t["content"]: t["id"] for t in definition["added_tokens"]}
        for text, number in self.special.items():
            raw[number] = text.encode()
        self.at_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        split = definition["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split)
        # texts beyond Latin letters are cut by the library itself, whose Unicode tables may differ
        library = Tokenizer.from_str(spec)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        # the offset table of the decoder; tokens are joined by one space
        size = max(raw) + 1
        self.buffer = np.frombuffer(b"".join(raw.get(i, b"") + b" " for i in range(size)), np.uint8)
        lengths = np.array([len(raw.get(i, b"")) + 1 for i in range(size)], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(lengths)])
        self.decimal = [str(i) for i in range(size)]

    # -- encoding ------------------------------------------------------------------------------

    def fits(self, first: int, second: int) -> bool:
        """Whether BPE keeps the border between two tokens that stand side by side."""
        key = (first, second)
        known = self.compatible.get(key)
        if known is None:
            known = self.compatible[key] = self._keeps_border(first, second)
        return known

    def _keeps_border(self, a: int, b: int) -> bool:
        """Undo merges beside the border, latest first. At each state only merges made before the
        one just undone could have joined the pair across the border; if one could, BPE joined it.

        Of two merges with one rank the left one is made first, so undoing the right one at rank r
        lets a pair of rank r itself still win, undoing the left one does not.
        """
        rank, made = self.rank, self.made
        limit = 1 << 60
        while True:
            joined = made.get((a, b))
            if joined is not None and rank[joined] < limit:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, self.right[a]
            else:
                limit, b = rb + 1, self.left[b]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word, given as symbols (code points below 512).

        Takes for granted that every token is the encoding of its own string, as in vocabularies
        that BPE training made (a test checks it for the file used).
        """
        size = len(word)
        longest = [-1] * size
        reach = [0] * size
        for end, (n, number) in self.machine.iter(word):
            start = end + 1 - n
            if n > reach[start]:
                reach[start], longest[start] = n, number
        open_at = [True] * (size + 1)
        out: list[int] = []
        position, token = 0, longest[0]
        while position < size:
            if token >= 0:
                end = position + self.length[token]
                if open_at[end] and (not out or self.fits(out[-1], token)):
                    out.append(token)
                    position = end
                    token = longest[position] if position < size else -1
                    continue
                token = self.shorter[token]
            if token < 0:  # nothing fits from here: never come back, try less at the token before
                open_at[position] = False
                token = out.pop()
                position -= self.length[token]
        return out

    def _word_ids(self, piece: str) -> bytes:
        """Ids of a word as the bytes of 32-bit numbers, the smallest form to keep."""
        known = self.words.get(piece)
        if known is None:
            data = piece.encode()
            word = data[:-1].decode("latin-1") + chr(data[-1] + END)
            known = self.words[piece] = np.array(self.encode_word(word), np.int32).tobytes()
            if len(self.words) > CACHE_WORDS:
                self.words.popitem(last=False)
        return known

    def pieces_of(self, text: str) -> list[str]:
        """Normalised words of a text without special tokens."""
        if text.isascii() or max(text) < "ɐ":
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            return self.pieces.findall(text.lower())
        cut = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        byte = {c: b for b, c in enumerate(byte_symbols())}
        return [bytes(byte[c] for c in piece).decode() for piece, _ in cut]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, as the library encodes it without adding special tokens."""
        parts: list[bytes] = []
        start = 0
        if self.at_special is not None and "<|" in text:
            for found in self.at_special.finditer(text):
                parts += map(self._word_ids, self.pieces_of(text[start:found.start()]))
                parts.append(np.int32(self.special[found.group()]).tobytes())
                start = found.end()
        get = self.words.get
        for piece in self.pieces_of(text[start:] if start else text):
            ids = get(piece)
            parts.append(ids if ids is not None else self._word_ids(piece))
        return np.frombuffer(b"".join(parts), np.int32)

    # -- decoding ------------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """Text of token ids: their strings joined by one space (the file names no decoder)."""
        if not len(ids):
            return ""
        starts = self.offset[ids]
        sizes = self.offset[np.asarray(ids) + 1] - starts
        ends = np.cumsum(sizes)
        index = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.buffer[index[:-1]].tobytes().decode()


def vocabulary(name_or_path: str = "word_bpe_49k.json") -> str:
    """The definition of a public tokenizer: a name of the installed set, or a path."""
    import public_tokenizers

    path = name_or_path if "/" in name_or_path else public_tokenizers.path(name_or_path)
    with open(path, encoding="utf-8") as f:
        return f.read()


class _Lazy:
    """The tables, built from the broadcast definition once in each worker process.

    A process that runs many tasks keeps them, with the words already encoded (``CACHE_WORDS``), in a
    module of its own making; of several definitions it keeps the last one.
    """

    def __init__(self, spec):
        self.spec, self.codec = spec, None
        self.name = hashlib.sha256(spec.value.encode()).hexdigest()

    def __call__(self) -> WordBpe:
        if self.codec is None:
            kept = vars(sys.modules.setdefault("_quire_worker_tables", types.ModuleType("_quire_worker_tables")))
            if kept.get("definition") != self.name:
                kept["definition"], kept["codec"] = self.name, WordBpe(self.spec.value)
            self.codec = kept["codec"]
        return self.codec

    def __getstate__(self):
        return {"spec": self.spec, "codec": None, "name": self.name}


def bpe_encode(docs: DataFrame, text: str = "text", ids: str = "ids",
               tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """``docs`` with the token ids of ``text`` in column ``ids`` (``array<int>``)."""
    return _with(docs, text, ids, "array<int>", tokenizer,
                 lambda codec, column: [codec.encode(t) for t in texts_of(column)])


def bpe_decode(docs: DataFrame, ids: str = "ids", text: str = "text",
               tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """``docs`` with the text of the token ids (null ids: empty) in column ``text``."""
    def decode(codec, column):
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
        return [codec.decode(values[a:b]) for a, b in zip([0, *ends.tolist()], ends.tolist())]

    return _with(docs, ids, text, "string", tokenizer, decode)


def _with(docs, source, target, kind, tokenizer, function):
    codec = _Lazy(docs.sparkSession.sparkContext.broadcast(vocabulary(tokenizer)))
    kept = [f for f in docs.schema.fields if f.name != target]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
                       + [f"`{target}` {kind}"])

    def run(batch):
        out = {f.name: batch.column(i) for i, f in enumerate(fields) if f.name != target}
        return out | {target: function(codec(), batch.column(at))}

    fields, at = docs.schema.fields, docs.columns.index(source)
    return arrow_map(docs, run, schema)


def bpe_encode_decode(docs: DataFrame, text: str = "text", ids: str = "ids",
                      decoded: str = "decoded_sha256", tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """``docs`` with the token ids of ``text`` in column ``ids`` and the SHA-256 of the text they
    decode to in column ``decoded``, in one pass: a task holds one copy of the tables."""
    codec = _Lazy(docs.sparkSession.sparkContext.broadcast(vocabulary(tokenizer)))
    kept = [f for f in docs.schema.fields if f.name not in (ids, decoded)]
    places, at = [docs.columns.index(f.name) for f in kept], docs.columns.index(text)

    def run(batch):
        bpe = codec()
        found = [bpe.encode(t) for t in texts_of(batch.column(at))]
        return ({f.name: batch.column(i) for f, i in zip(kept, places)}
                | {ids: found, decoded: [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in found]})

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
                       + [f"`{ids}` array<int>", f"`{decoded}` string"])
    return arrow_map(docs, run, schema)


def bpe_digests(docs: DataFrame, key: str = "doc_id", text: str = "text",
                tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """Per row: token count, and SHA-256 of the ids as text and of the decoded text.

    Encodes and decodes in one pass, so the ids of a large table need not be stored.
    """
    codec = _Lazy(docs.sparkSession.sparkContext.broadcast(vocabulary(tokenizer)))

    def run(batch):
        bpe = codec()
        number, rows = bpe.decimal, ([], [], [])
        for t in texts_of(batch.column(1)):
            ids = bpe.encode(t)
            rows[0].append(len(ids))
            joined = " ".join([number[i] for i in ids.tolist()])
            rows[1].append(hashlib.sha256(joined.encode()).hexdigest())
            rows[2].append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        return {key: batch.column(0), "n_tokens": rows[0], "ids_sha256": rows[1],
                "decoded_sha256": rows[2]}

    kind = docs.schema[key].dataType.simpleString()
    return arrow_map(docs.select(F.col(key), F.col(text)), run,
                     f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
