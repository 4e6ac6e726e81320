"""Texts cut at spaces as Arrow arrays of numbered chunks, and an encoder that asks a tokenizers model
for each distinct chunk once as long as a worker remembers it.

Cutting and numbering run on whole Arrow arrays; Python objects are made for distinct chunks only.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from waitcast.llm.bpe import chunks, ragged

#: A worker's memory of chunks is started anew at so many.
CACHE_CHUNKS = 3 << 19
#: Texts are worked through in pieces of about so many bytes.
PIECE_BYTES = 1 << 22

#: The two text schemes for which chunks between spaces are known to be independent.
BYTE_LEVEL = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
WORD_LEVEL = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})

#: Letters from A to U+012F have one lower-case letter each and no other normal form; a run of them is one pre-token.
_LETTER = "A-Za-zÀ-ÖØ-öø-į"
_LETTERS = re.compile(f"[{_LETTER}]+")
#: ASCII signs but the apostrophe, which starts pre-tokens of its own.
_SIGN = "!-&(-/:-@\\[-`{-~"
_SIMPLE = re.compile(f"[{_LETTER}0-9{_SIGN}]+")
_PRETOKEN = re.compile(f"[{_LETTER}]+|[0-9]|[{_SIGN}]+")
#: Stands before a chunk that no space comes before; texts that hold it go to the library whole.
_MARK = "\x01"
#: The same in byte-level schemes, where digits make runs and a line feed between other characters stands alone.
_SIMPLE_LINES = re.compile(f"[{_LETTER}0-9{_SIGN}]+(?:\n[{_LETTER}0-9{_SIGN}]+)*")
_BYTE_PRETOKEN = re.compile(f"[{_LETTER}]+|[0-9]+|[{_SIGN}]+|\n")


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


_BYTE = _byte_letters()


def _spelled(text: str) -> str:
    return "".join(_BYTE[b] for b in text.encode())


_UPPER = {ord(c): _spelled(c) for c in map(chr, [0x0A, *range(0xC0, 0x130)])}
_LOWER = {ord(c): _spelled(c.lower()) for c in map(chr, range(0xC0, 0x130))} | {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """Slices of a large-string array of about ``limit`` bytes, one text at least."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else np.zeros(0, np.int64)
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield texts.slice(at, upto - at)
        at = upto


def large(texts: pa.Array) -> pa.Array:
    """Texts as large strings, null as empty."""
    return pc.fill_null(texts.cast(pa.large_string()), "")


@dataclass
class Ids:
    """Token ids of some texts, one after another; text i has sizes[i] of them."""

    flat: np.ndarray
    sizes: np.ndarray

    def ended(self, end_id: int) -> Ids:
        """The same with ``end_id`` after each text."""
        sizes = self.sizes + 1
        flat = np.full(int(sizes.sum()), end_id, np.uint32)
        own = np.ones(len(flat), bool)
        own[np.cumsum(sizes) - 1] = False
        flat[own] = self.flat
        return Ids(flat, sizes)

    def each(self) -> Iterator[np.ndarray]:
        ends = np.cumsum(self.sizes)
        for a, b in zip(ends - self.sizes, ends, strict=True):
            yield self.flat[a:b]


class Encoder:
    """Encodes texts as the tokenizers library does for this model (its JSON) with add_special_tokens=False.

    In the two known schemes a pre-token never reaches over a space that is cut here, so texts are cut there.
    Texts that hold the string of an added token, and all texts of a model of another scheme, go to the library whole.
    """

    def __init__(self, model: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.json, self.tokenizer = model, Tokenizer.from_str(model)
        self.model = self.tokenizer.model
        told = json.loads(model)
        added = told.get("added_tokens") or []
        self.added = [t["content"] for t in added]
        scheme = (told.get("normalizer"), told.get("pre_tokenizer"))
        settled = (told.get("post_processor") is None and told.get("truncation") is None and told["model"].get("type") == "BPE"
                   and not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
                   # no added token starts or ends with white space, so none reaches over a place cut here
                   and all(c == c.strip() and " " not in c and "\n" not in c for c in self.added))
        self.byte_level, self.word_level = settled and scheme == BYTE_LEVEL, settled and scheme == WORD_LEVEL
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.spelled: dict[str, list[int]] = {}

    def _model_ids(self, spelled: str) -> list[int]:
        found = self.spelled.get(spelled)
        if found is None:
            found = self.spelled[spelled] = [t.id for t in self.model.tokenize(spelled)]
        return found

    def _by_library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, fresh: list[str]) -> list[list[int]]:
        """Ids of chunks in the scheme of lower-cased words; A-Z are lower-cased before."""
        found: list[list[int] | None] = [None] * len(fresh)
        other, ask, kept = [], self.model.tokenize, self._model_ids
        for i, c in enumerate(fresh):
            if c.isalpha() and c.isascii():
                found[i] = [t.id for t in ask(c)]
            elif _LETTERS.fullmatch(c):
                found[i] = [t.id for t in ask(c.translate(_LOWER))]
            elif not c:
                found[i] = []
            elif _SIMPLE.fullmatch(c):
                found[i] = list(chain.from_iterable(kept(p.translate(_LOWER)) for p in _PRETOKEN.findall(c)))
            else:
                other.append(i)
        for i, ids in zip(other, self._by_library([fresh[i] for i in other]), strict=True):
            found[i] = ids
        return found

    def _byte_ids(self, fresh: list[str]) -> list[list[int]]:
        """Ids of byte-level chunks, each after a space unless it starts with the mark."""
        found: list[list[int] | None] = [None] * len(fresh)
        other, ask, kept = [], self.model.tokenize, self._model_ids
        for i, c in enumerate(fresh):
            c, space = (c[1:], "") if c[:1] == _MARK else (c, _BYTE[0x20])
            if c.isalpha() and c.isascii():
                found[i] = [t.id for t in ask(space + c)]
            elif _LETTERS.fullmatch(c):
                found[i] = [t.id for t in ask(space + c.translate(_UPPER))]
            elif _SIMPLE_LINES.fullmatch(c):
                first, *rest = _BYTE_PRETOKEN.findall(c)
                found[i] = list(chain(kept(space + first.translate(_UPPER)), *[kept(p.translate(_UPPER)) for p in rest]))
            else:
                other.append(i)
        texts = [fresh[i][1:] if fresh[i][:1] == _MARK else f" {fresh[i]}" for i in other]
        for i, ids in zip(other, self._by_library(texts), strict=True):
            found[i] = ids
        return found

    def _numbers(self, keys: list[str], ids_of: Callable[[list], list[list[int]]]) -> np.ndarray:
        """The number of each of some different keys in this worker's memory; ids of those not known are asked for."""
        codes = self.codes
        numbers = list(map(codes.get, keys))
        fresh = [i for i, n in enumerate(numbers) if n is None]
        if fresh:
            found = ids_of([keys[i] for i in fresh])
            size = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))
            for n, i in enumerate(fresh, len(codes)):
                codes[keys[i]] = numbers[i] = n
            self.start = np.concatenate([self.start, np.cumsum(size) - size + len(self.ids)])
            self.size, self.ids = np.concatenate([self.size, size]), np.concatenate([self.ids, flat])
        return np.array(numbers, np.int64)

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all chunks of the texts, and how many chunks each text has."""
        if self.word_level:
            # signs between a letter and white space are a pre-token
            apart = pc.replace_substring_regex(pc.ascii_lower(texts), f"([{_LETTER}])([.,;:!?]+)(?:[ \\n]|$)", r"\1 \2 ")
            cut = pc.split_pattern(pc.replace_substring(apart, "\n", " "), " ")
            coded = cut.flatten().dictionary_encode()
            codes = self._numbers(coded.dictionary.to_pylist(), self._word_ids)
            return codes[coded.indices.to_numpy()], np.diff(cut.offsets.to_numpy())
        # a space goes with what follows it, unless white space or the end follows; the mark stands for no space
        loose = pc.match_substring_regex(texts, r" (?:[\s\x0b\x1c-\x1f\x{85}\p{Z}]|$)").to_numpy(zero_copy_only=False)
        strict = texts.filter(pa.array(~loose))
        strict = pc.replace_substring_regex(strict, f"([{_LETTER}0-9{_SIGN}])\n([{_LETTER}0-9{_SIGN}])", f"\\1 {_MARK}\n {_MARK}\\2")
        strict = pc.replace_substring_regex(strict, f"([{_LETTER}])([.,;:!?]+)( |$)", rf"\1 {_MARK}\2\3")
        cut = pc.split_pattern(pc.binary_join_element_wise(pa.scalar(_MARK, pa.large_string()), strict, pa.scalar("", pa.large_string())), " ")
        chunked = cut.flatten(), np.diff(cut.offsets.to_numpy())
        if loose.any():
            lists = [chunks(t) for t in texts.filter(pa.array(loose)).to_pylist()]
            for c in lists:
                c[0] = _MARK + c[0]
            flat = pa.concat_arrays([chunked[0], pa.array(chain.from_iterable(lists), pa.large_string())])
            sizes = np.concatenate([chunked[1], np.fromiter(map(len, lists), np.int64, len(lists))])
        else:
            flat, sizes = chunked
        coded = flat.dictionary_encode()
        numbers = self._numbers(coded.dictionary.to_pylist(), self._byte_ids)[coded.indices.to_numpy()]
        n, m = len(chunked[0]), len(chunked[1])
        return _interleave(loose, (numbers[:n], sizes[:m]), (numbers[n:], sizes[m:]))

    def __call__(self, texts: pa.Array) -> Ids:
        """Ids of a large-string array without nulls."""
        if len(self.codes) + len(self.spelled) > CACHE_CHUNKS:
            self.clear()
        if not (self.byte_level or self.word_level):
            return _of_lists(self._by_library(texts.to_pylist()))
        whole = np.zeros(len(texts), bool)
        for content in (*self.added, *([_MARK] if self.byte_level else [])):
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        numbers, n_chunks = self._cut(texts.filter(pa.array(~whole)))
        size = self.size[numbers]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n_chunks)])]
        cut = Ids(self.ids[ragged(self.start[numbers], size)], np.diff(ends))
        if not whole.any():
            return cut
        held = _of_lists(self._by_library(texts.filter(pa.array(whole)).to_pylist()))
        return Ids(*_interleave(whole, (cut.flat, cut.sizes), (held.flat, held.sizes)))


def _of_lists(lists: list[list[int]]) -> Ids:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return Ids(np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes)


def _interleave(second: np.ndarray, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two ragged arrays (flat, sizes) as one: rows of ``b`` where ``second``, of ``a`` elsewhere."""
    if not second.any():
        return a
    sizes, starts = np.zeros(len(second), np.int64), np.zeros(len(second), np.int64)
    sizes[~second], sizes[second] = a[1], b[1]
    starts[~second], starts[second] = np.cumsum(a[1]) - a[1], np.cumsum(b[1]) - b[1] + len(a[0])
    return np.concatenate([a[0], b[0]])[ragged(starts, sizes)], sizes


_worker: list[Encoder] = []


def worker_encoder(model: str) -> Encoder:
    """The encoder of this Python worker, which remembers chunks over its tasks, up to CACHE_CHUNKS."""
    if not _worker or _worker[0].json != model:
        _worker[:] = [Encoder(model)]
    return _worker[0]
