"""Token ids of whole texts by a public byte-level BPE, with a cache of units.

A byte-level BPE first splits a text by a pattern, and no token crosses such a
split. Texts are cut at splits here: into words (letters and digits together),
signs and white space, as that pattern would. Each different unit is encoded by
the tokenizer itself, once per worker while it stays in use. Texts with the
tokenizer's special token, or with control signs that only Python takes for
white space, are encoded whole.

Texts of Latin letters, signs and digits, which all Unicode versions class alike,
go through a second implementation of the same vocabulary, several times as fast:
merges in the order of their ids, behind the same split. It is used where the
vocabulary's file says that this is what it does, and not for very long runs.
"""

import json
import re
from array import array
from itertools import chain

import numpy as np

#: Units that a worker remembers in each of two generations.
_REMEMBERED = 400_000
_LONG = 64
#: Splits of the vocabulary's pattern that matter here, in its order.
_UNIT = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W_]+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+")
#: Signs beyond the Latin letters, and runs that the second implementation takes long for.
_BEYOND = re.compile("[^\0-\u024f]")
_RUN = 500
_SPACES = tuple(sign * _RUN for sign in " \n\t\r")
#: Fixed value: the split of byte-level vocabularies without a pattern of their own.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CONTROLS = "\x1c\x1d\x1e\x1f"


def _byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary's file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (byte for byte in range(256) if byte not in shown)
    return {chr(byte): byte for byte in shown} | {chr(256 + n): byte for n, byte in enumerate(hidden)}


def _second(path: str):
    """The vocabulary as merges by id; None where its file asks for anything else."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    split, model = told.get("pre_tokenizer") or {}, told["model"]
    plain = (
        told.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and model.get("type") == "BPE"
        and not any(model.get(name) for name in ("dropout", "byte_fallback", "ignore_merges"))
    )
    if not plain:
        return None
    pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
    order = [model["vocab"]["".join(pair)] for pair in pairs]
    if order != sorted(order):
        return None
    signs = _byte_signs()
    special = {token["content"] for token in told.get("added_tokens", [])}
    ranks = {
        bytes(signs[sign] for sign in token): number
        for token, number in model["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding("second", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [
            token.content for token in self.tokenizer.get_added_tokens_decoder().values()
        ]
        self.second = _second(path)
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _packed(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() for one in encoded]

    def _is_plain(self, text: str) -> bool:
        return not any(sign in text for sign in (*_CONTROLS, *self.special))

    def _is_latin(self, text: str) -> bool:
        """Whether the second implementation takes a plain text."""
        return (
            self.second is not None
            and not _BEYOND.search(text)
            and max(map(len, text.split()), default=0) < _RUN
            and not any(run in text for run in _SPACES)
        )

    def _remember(self, units: set[str]) -> None:
        """Have all units in ``seen``; what was not used for a while is forgotten."""
        if len(self.seen) > _REMEMBERED:
            self.older, self.seen = self.seen, {}
        new = units - self.seen.keys()
        again = new & self.older.keys()
        self.seen.update((unit, self.older[unit]) for unit in again)
        new = list(new - again)
        self.seen.update(zip(new, self._packed(new), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        result: list[bytes | None] = [None] * len(texts)
        for at, text in enumerate(texts):
            if self._is_plain(text) and self._is_latin(text):
                result[at] = array("I", self.second.encode_ordinary(text)).tobytes()
        others = [at for at, ids in enumerate(result) if ids is None]
        for at, ids in zip(others, self._by_units([texts[at] for at in others]), strict=True):
            result[at] = ids
        return result

    def _by_units(self, texts: list[str]) -> list[bytes]:
        cut = [_UNIT.findall(text) if self._is_plain(text) else None for text in texts]
        units = set(chain.from_iterable(filter(None, cut)))
        self._remember(units)
        whole = iter(
            self._packed([text for text, own in zip(texts, cut, strict=True) if own is None])
        )
        known = self.seen.__getitem__
        result = [next(whole) if own is None else b"".join(map(known, own)) for own in cut]
        for unit in units:
            if len(unit) > _LONG:
                del self.seen[unit]
        return result


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
