"""Byte pair encoding without merging: the last token of every prefix, by dynamic programming.

The encoding of a word is its only sequence of tokens in which every two neighbours are stable: if
their spelling alone were merged pair by pair, nothing would ever merge across the place where they
meet. So each prefix has one last token, one of those the vocabulary's automaton finds to end there,
which goes with the last token of the prefix before it. Following these back gives the encoding.
"""

import functools
import json
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from usagelens.llm.rows import keyed
from usagelens.llm.words import pieces, utf8

#: Added to the code of a symbol that ends a word.
_LAST = 1 << 16
_PIECE = 1 << 22
_GAP = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_UNLIKE = re.compile("[\x1c-\x1f]")

#: What word_bpe_49k.json declares for normalizing and splitting. Of texts of printable
#: Latin-1 this is the same as lower case and the pattern below; others go through the library.
_DECLARED = {
    "normalizers": ["NFC", {"Regex": "\\s+"}, "Lowercase"],
    "pattern": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}
_OTHER = re.compile("[^\t-\r -~\xa1-\xff]|<\\|")
_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\t-\\r {_LETTER}{_NUMBER}]+"
)


def _is_declared(described: dict[str, Any]) -> bool:
    """Whether a file normalizes and splits as ``_DECLARED``."""
    try:
        steps = described["normalizer"]["normalizers"]
        split, to_bytes = described["pre_tokenizer"]["pretokenizers"]
        found = [s["pattern"] if s["type"] == "Replace" else s["type"] for s in steps]
        return (
            found == _DECLARED["normalizers"]
            and steps[1]["content"] == " "
            and split["pattern"] == {"Regex": _DECLARED["pattern"]}
            and (split["behavior"], split["invert"]) == ("Removed", True)
            and (to_bytes["type"], to_bytes["add_prefix_space"], to_bytes["use_regex"])
            == ("ByteLevel", False, False)
        )
    except (KeyError, TypeError, ValueError, IndexError):
        return False


@functools.cache
def _byte_names() -> dict[int, str]:
    """Bytes, as characters of Latin-1, by the characters that stand for them in such files:
    themselves where printable, else the next from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {256 + i: chr(b) for i, b in enumerate(hidden)}


class Remembered(dict):
    """Values made once for a key and kept for the keys of late: at most twice ``most`` of them."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self._make, self._most, self._older = make, most, {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        if len(self) >= self._most:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value


class Merges:
    """The tokens of a ``tokenizers`` BPE file whose words end in a marked symbol.

    A word is spelled in symbols, its bytes as Latin-1, the last of them marked. Ids, halves and ranks are those of the
    file's merges. Files whose merges do not make each token in one way, from tokens made before
    it, are refused, as are options that change how words are merged.
    """

    def __init__(self, model: dict[str, Any]):
        for option in ("dropout", "unk_token", "continuing_subword_prefix"):
            if model.get(option):
                raise ValueError(f"a vocabulary with {option} is not supported")
        for option in ("byte_fallback", "ignore_merges", "fuse_unk"):
            if model.get(option):
                raise ValueError(f"a vocabulary with {option} is not supported")
        if model["type"] != "BPE" or not model["end_of_word_suffix"]:
            raise ValueError("only BPE vocabularies with a mark at the end of words are supported")
        ids: dict[str, int] = model["vocab"]
        mark = model["end_of_word_suffix"]
        self.size = max(ids.values()) + 1
        self.left, self.right = [-1] * self.size, [-1] * self.size
        self.rank = [-1] * self.size
        self.ranks: dict[int, int] = {}
        spelled: dict[int, str] = {}
        byte = _byte_names()
        made = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        whole = {ids[a + b] for a, b in made}
        for name, i in ids.items():
            if i not in whole:
                short = name.removesuffix(mark)
                if len(name) == 1:
                    spelled[i] = byte[ord(name)]
                elif len(short) == 1:
                    spelled[i] = chr(ord(byte[ord(short)]) + _LAST)
                else:
                    raise ValueError(f"no merge makes the token {name!r}")
        for rank, (a, b) in enumerate(made):
            a, b, i = ids[a], ids[b], ids[a + b]
            if i in spelled or a not in spelled or b not in spelled:
                raise ValueError(f"merge {rank} does not make a new token of older ones")
            self.left[i], self.right[i], self.rank[i] = a, b, rank
            self.ranks[a * self.size + b] = rank
            spelled[i] = spelled[a] + spelled[b]
        reached: set[int] = set()
        for i in sorted(spelled, key=self.rank.__getitem__):
            a, b = self.left[i], self.right[i]
            if a < 0 or (a in reached and b in reached and self.stable(a, b, self.rank[i])):
                reached.add(i)
        self.spelled = {i: spelled[i] for i in reached}

    def stable(self, a: int, b: int, until: int = 1 << 62) -> bool:
        """Whether nothing merges across the place where the tokens meet, before rank ``until``.

        Going back in time, the younger of the tokens at the place falls into its halves. A pair
        would have merged if that came before either of its tokens went into a greater one; of
        equal pairs the one further left merges first.
        """
        rank, left, right, ranks, size = self.rank, self.left, self.right, self.ranks, self.size
        end_a = end_b = until
        while True:
            merged = ranks.get(a * size + b)
            if merged is not None and merged < end_a and (merged < end_b or merged == end_b < until):
                return False
            if rank[a] > rank[b]:
                end_a, a = rank[a], right[a]
            elif rank[b] >= 0:
                end_b, b = rank[b], left[b]
            else:
                return True


def _as_bytes(tokens: list[int]) -> bytes:
    numbers = array("I", tokens)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class Encoder:
    """Ids of texts by a ``tokenizers`` file, as that library gives them without added ones.

    What the file says of normalizing and splitting is done by that library, chunk by chunk, for
    texts where it does more than lower case and one pattern; such a text is cut at white space
    first, which neither can cross. Recent words and pairs are remembered.
    """

    def __init__(self, path: str, most: int = 1 << 17):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self._merges = Merges(described["model"])
        self._automaton = ahocorasick.Automaton()
        self._length = [0] * self._merges.size
        for i, spelling in self._merges.spelled.items():
            self._automaton.add_word(spelling, i)
            self._length[i] = len(spelling)
        self._automaton.make_automaton()
        library = Tokenizer.from_file(path)
        self._normal = library.normalizer.normalize_str
        self._split = library.pre_tokenizer.pre_tokenize_str
        self._added = {t["content"]: t["id"] for t in described["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in described["added_tokens"]):
            raise ValueError("added tokens matched by more than their names are not supported")
        names = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._names = re.compile(f"({'|'.join(names)})") if names else None
        plain = _is_declared(described) and all(n.startswith("<|") for n in self._added)
        self._other = _OTHER if plain else re.compile("")
        self._stable = Remembered(self._pair, most)
        self._words = Remembered(self._word, most)
        self._chunks = Remembered(self._chunk, most >> 3)

    def _pair(self, pair: int) -> bool:
        return self._merges.stable(*divmod(pair, self._merges.size))

    def word(self, symbols: str) -> list[int]:
        """The tokens of a word spelled in symbols, the last of them marked."""
        last = [-1] * len(symbols)
        length, stable, size = self._length, self._stable, self._merges.size
        for end, token in self._automaton.iter(symbols):  # of one end the longest first
            if last[end] < 0:
                before = end - length[token]
                if before < 0 or (last[before] >= 0 and stable[last[before] * size + token]):
                    last[end] = token
        tokens, at = [], len(symbols) - 1
        while at >= 0:
            token = last[at]
            if token < 0:
                raise ValueError("a symbol is missing in the vocabulary")
            tokens.append(token)
            at -= length[token]
        tokens.reverse()
        return tokens

    def _word(self, word: str) -> bytes:
        symbols = word.encode().decode("latin-1")
        tokens = self.word(symbols[:-1] + chr(ord(symbols[-1]) + _LAST))
        return _as_bytes(tokens)

    def _chunk(self, chunk: str) -> bytes:
        found = []
        parts = self._names.split(chunk) if self._names else [chunk]
        for i, part in enumerate(parts):  # names are at the odd places
            if i % 2:
                found.append(_as_bytes([self._added[part]]))
            elif part:
                for piece, _ in self._split(self._normal(part)):
                    symbols = piece.translate(_byte_names())
                    tokens = self.word(symbols[:-1] + chr(ord(symbols[-1]) + _LAST))
                    found.append(_as_bytes(tokens))
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        found, words = [], self._words.__getitem__
        for part in _slices(text):
            if not self._other.search(part):
                found += map(words, _WORDS.findall(part.lower()))
                continue
            for chunk in _GAP.split(part) if _UNLIKE.search(part) else part.split():
                if self._other.search(chunk):
                    found.append(self._chunks[chunk])
                else:
                    found += map(words, _WORDS.findall(chunk.lower()))
        return b"".join(found)


def _slices(text: str) -> Iterator[str]:
    """The text in slices of some megabytes, cut at white space."""
    at = 0
    while len(text) - at > _PIECE:
        gap = _GAP.search(text, at + _PIECE)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:]


@functools.lru_cache(2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


@functools.lru_cache(2)
def _names(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    if described["decoder"] is not None:
        raise ValueError("a vocabulary with a decoder is not supported")
    ids = described["model"]["vocab"] | {t["content"]: t["id"] for t in described["added_tokens"]}
    names = [""] * (max(ids.values()) + 1)
    for name, i in ids.items():
        names[i] = name
    return names


def encode(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n_tokens, ids``, one row per row of ``docs``.

    ``ids`` are those that ``tokenizers`` gives with the file at ``tokenizer_path``, a path every
    executor can read, and ``add_special_tokens=False``, as little-endian unsigned 32-bit numbers.
    A null text counts as empty and has none. Texts of any length are read some megabytes at a
    time; rows with equal ids or texts each get their row, and other columns are ignored.
    """

    def run(batches):
        encoder = _encoder(tokenizer_path)
        for batch in batches:
            _, offsets = utf8(batch["text"])
            for first, last in pieces(offsets, _PIECE):
                texts = batch["text"].slice(first, last - first)
                ids = [encoder.encode(t.as_py()) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].slice(first, last - first),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["id", "n_tokens", "ids"],
                )

    rows = keyed(docs, id_col, text_col).select("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text that ``tokenizers`` gives for ``ids_col`` with
    ``skip_special_tokens=False``: as the file names no decoder, its tokens joined by a space. Null
    ids count as none and give an empty text; an id the file lacks is an error."""
    columns = encoded.columns

    def run(batches):
        names = _names(tokenizer_path)
        for batch in batches:
            sizes = np.array([len(x.as_buffer() or b"") if x.is_valid else 0 for x in batch[ids_col]])
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            for first, last in pieces(bounds, _PIECE):
                texts = []
                for value in batch[ids_col].slice(first, last - first):
                    ids = np.frombuffer(value.as_py() or b"", "<u4").tolist()
                    texts.append(" ".join(map(names.__getitem__, ids)))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], [*columns, "decoded"]
                )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields]
    return encoded.mapInArrow(run, ", ".join([*fields, "decoded string"]))
