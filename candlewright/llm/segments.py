"""Texts cut where no subword token can run across, and the tokens of those segments, kept for later texts.

A single space between two characters that aren't white space begins a token in byte-level vocabularies (their pattern
keeps a leading space with what follows and never runs over one) and in vocabularies whose word mark stands only in
front of pieces. So the tokens of a text are those of its segments one after another, and a segment met before need
not be encoded again. Segments are kept with their leading space left out; ``REMEMBERED`` short ones at most.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# The first cut of byte-level tokenizer files, and the pattern behind its use_regex.
FIRST_CUT = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of segments that are kept, with 60 more for each; beyond it the memory begins anew.
REMEMBERED = 60_000_000
#: Segments joined for one call of an encoder.
JOINED = 300
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r" (?:(?=\s)|(?<=\s ))")


def segments(text: str) -> list[str]:
    """``" ".join(segments(text)) == text``; tokens end at every joint."""
    odd = text.startswith(" ") or text.endswith(" ") or _ODD.search(text)
    return _CUT.split(text) if odd else text.split(" ")


def runs(found: Iterable[str]) -> list[list[str]]:
    """Segments in groups that may be joined by single spaces without a change of tokens; others stand alone."""
    found = list(found)
    alone = [s for s in found if not s or len(s.strip()) != len(s)]
    if alone:
        apart = set(alone)
        found = [s for s in found if s not in apart]
    return [found[a:a + JOINED] for a in range(0, len(found), JOINED)] + [[s] for s in alone]


def byte_level() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level tokenizer file, and the bytes of its ids."""

    def __init__(self, path: str, specials_as_text: bool):
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = specials_as_text
        decoded = byte_level()
        entries = self.model.get_vocab(with_added_tokens=True)
        special = {t.content for t in self.model.get_added_tokens_decoder().values()}
        self.specials = sorted(special)
        self.bytes = [b""] * (max(entries.values()) + 1)
        for text, i in entries.items():
            self.bytes[i] = text.encode() if text in special else bytes(decoded[c] for c in text)
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]


def ends_in(run: list[str], data: bytes, lengths: np.ndarray) -> np.ndarray:
    """How many tokens of a joined run (``data`` is its text with a space before it) lie up to the end of each segment."""
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    if len(spaces) == len(run):
        places = np.append(spaces[1:], len(data))
    else:  # segments hold spaces of their own
        places = np.cumsum(np.fromiter((len(s.encode()) + 1 for s in run), np.int64, len(run)))
    ends = np.cumsum(lengths)
    upto = np.searchsorted(ends, places)
    if len(ends) == 0 or ends[-1] != places[-1] or (ends[upto] != places).any():
        raise ValueError("a token runs across segments")
    return upto + 1


def as_ranks(path: str) -> tiktoken.Encoding | None:
    """The same tokenizer for the faster library, special tokens as plain text; None where its ids aren't its merge order.

    Its time grows with the square of a run without a joint, so it is for segments of bounded length.
    """
    with open(path, encoding="utf-8") as opened:
        stored = json.load(opened)
    decoded, vocabulary = byte_level(), stored["model"]["vocab"]
    if stored["normalizer"] is not None or stored["pre_tokenizer"] != FIRST_CUT:
        return None
    special = {t["content"] for t in stored["added_tokens"]}
    ranks = {bytes(decoded[c] for c in text): i for text, i in vocabulary.items() if text not in special}
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in stored["model"]["merges"]]
    if sorted(ranks.values()) != list(range(len(ranks))) or merged != list(range(256, 256 + len(merged))):
        return None
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
