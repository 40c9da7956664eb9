"""Word-wise use of the public tokenizers inside Python workers: each distinct piece of text is encoded once.

Neither tokenizer lets a token cross the places at which texts are split here, so that counts and
ids are those of the whole text; tests compare both on whole documents.
"""

from __future__ import annotations

import re
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: A worker forgets what it has encoded beyond so many entries, which bounds its memory.
ENTRIES = 400_000
#: Of ids, it keeps so many entries and as many older ones.
KEPT = 131_072

_cache: dict[str, dict] = {}
_models: dict[str, object] = {}


def bounded(name: str) -> dict:
    found = _cache.setdefault(name, {})
    if len(found) > ENTRIES:
        found.clear()
    return found


def _vocabulary(path: str):
    if path not in _models:
        if path.endswith(".model"):
            import sentencepiece

            _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            _models[path] = Tokenizer.from_file(path)
    return _models[path]


#: The byte-level alphabet: printable Latin-1 stands for itself, the other bytes for code points from 256 on.
_PRINTABLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTES = {b: b for b in _PRINTABLE} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}
#: The tokenizer's own pre-token pattern, and the texts on which it is applied here: Latin-1 without white space, controls and special tokens.
_RUNS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_PLAIN = regex.compile(r"[\x21-\x7e\xa1-\xac\xae-\xff]+")


class Memory(dict):
    """Remembers what ``make`` gives for a key; what is not asked for again is forgotten after two fillings."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found

    def settle(self) -> "Memory":
        if len(self) > KEPT:
            self.old = dict(self)
            self.clear()
        return self


class _Words:
    """A lower-casing word BPE that drops white space: ids of chunks without ASCII white space."""

    def __init__(self, path: str):
        self.path = path
        self.model = _vocabulary(path).model
        self.runs, self.chunks = Memory(self._run), Memory(self._chunk)

    def _run(self, run: str) -> bytes:
        if not run.isascii():
            run = run.encode().decode("latin-1").translate(_BYTES)
        ids = [t.id for t in self.model.tokenize(run)]
        return pack(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: bytes) -> bytes:
        """Through the model's merges, each pre-token once; by the library as a whole where normalizing takes more than lower case."""
        x = chunk.decode()
        if x.isascii() and x.isalpha():
            return self.runs[x.lower()]
        if not _PLAIN.fullmatch(x) or "<|" in x:
            ids = _vocabulary(self.path).encode(x, add_special_tokens=False).ids
            return pack(f"<{len(ids)}I", *ids)
        if x[-1] in ".," and x[:-1].isalpha():
            return self.runs[x[:-1].lower()] + self.runs[x[-1]]
        return b"".join([self.runs[r] for r in _RUNS.findall(x.lower())])


def word_ids(texts: list[str], path: str) -> list[bytes]:
    """The texts' ids as little-endian unsigned 32-bit integers, for a lower-casing word BPE that drops white space.

    Texts are split at ASCII white space alone; every other character stays with its neighbours.
    """
    words = _words.get(path) or _words.setdefault(path, _Words(path))
    words.runs.settle()
    get = words.chunks.settle().__getitem__
    return [b"".join(map(get, x.encode().split())) for x in texts]


_words: dict[str, _Words] = {}


#: Texts in which blanks and line breaks stand apart from words, or that are empty, are split by a pattern; all others at single blanks.
_IRREGULAR = r"  |\n | \n|^[ \n]| $|^$"
_SPACED = re.compile(r"\n[^ \n]*| *[^ \n]+| +")


def pretokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens of the texts in a row, and where each text's begin and the last one's end; for a sentence-piece model without white space inside its pieces.

    A pre-token is a word with the blanks before it, the last of which is left out (the model puts
    one before whatever it encodes, the text included), or a line break with the word that follows
    it at once. The model's own mark for a blank is a blank, as it is for the model.
    """
    plain = pc.replace_substring(pc.fill_null(texts, ""), "\u2581", " ")
    odd = pc.match_substring_regex(plain, _IRREGULAR)
    lists = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
    if not pc.any(odd).as_py():
        return lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    where = odd.to_numpy(zero_copy_only=False)
    apart = [[x[1:] if x[0] == " " else x for x in _SPACED.findall(" " + t)] if t else [] for t in plain.filter(odd).to_pylist()]
    lengths = pc.list_value_length(lists).to_numpy().astype(np.int64)
    lengths[where] = list(map(len, apart))
    # the texts in their order again: those of both kinds have their tokens in a row each
    flat = pa.concat_arrays([lists.filter(pc.invert(odd)).flatten(), pa.array([x for a in apart for x in a], pa.string())])
    order = np.argsort(np.repeat(where, lengths), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return flat.take(pa.array(place)), np.concatenate(([0], np.cumsum(lengths)))


def piece_counts(distinct: list[str], path: str) -> list[int]:
    """How many pieces each pre-token has. A line break begins with the model's own blank, which is taken off again; a lone blank is that one."""
    return [1 if not x else len(ids) - (x[0] == "\n") for x, ids in zip(distinct, _vocabulary(path).encode(distinct, num_threads=1), strict=True)]
