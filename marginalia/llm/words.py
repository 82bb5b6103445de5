"""Ids of the ``tokenizers`` library, encoded by distinct segments."""

from __future__ import annotations

import os
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .segments import SegmentEncoder

#: Id that ends each document.
END = 2
#: Segments encoded by one call of the library.
TOGETHER = 2000


#: Marks that the tokenizer separates from a letter or digit before them.
_MARKS = ",.;:!?#*$%&"


#: A Latin letter or digit and the marks at a segment's end; characters that keep a text from being put in lower case before it is normalised: others than Latin ones may
#: compose with a letter, and special tokens are taken as they stand.
_AT_END = rf"([0-9A-Za-zÀ-ÖØ-öø-ÿ])([{_MARKS}]+)( |$)"
_AS_IT_IS = "[^\x00-\u02ff]|<[|]"


def _spaced(texts: pa.Array) -> pa.Array:
    """Texts with a space for each line feed, which the tokenizer drops alike, and one before the marks at a segment's end, where it ends a piece anyway; ASCII letters in lower case
    where that changes no id. So a block has fewer distinct segments, and most are a word or marks alone."""
    spaced = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " "), _AT_END, r"\1 \2\3")
    return pc.if_else(pc.match_substring_regex(texts, _AS_IT_IS), spaced, pc.ascii_lower(spaced))


def _pieces(segment: str) -> list[str]:
    """The marks at the end by themselves; ASCII letters in lower case, as the tokenizer's normaliser makes them, but not in what may hold a special token."""
    if "<|" in segment:
        return [segment]
    if segment.isalnum():
        return [segment.lower()] if segment.isascii() else [segment]
    core = segment.rstrip(_MARKS)
    marks = segment[len(core) :]
    if core.isascii():
        core = core.lower()
    if marks and core and len(core[-1].lower()) == 1 and core[-1].isalnum():
        return [core, marks]
    return [core + marks]


def _plain(s: str) -> bool:
    return s.isascii() or unicodedata.is_normalized("NFC", s)


@lru_cache(maxsize=4)
def word_encoder(path: str) -> SegmentEncoder:
    """The encoder of a worker for the tokenizer in ``path``, which must drop white space (so spaces separate segments).

    A segment's ids are little-endian unsigned 32-bit integers. Many segments go to the library as one string; a token
    belongs to the segment in which it starts. Segments whose normal form differs from them are encoded by themselves.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer = Tokenizer.from_file(path)

    def together(segments: list[str]) -> list[bytes]:
        e = tokenizer.encode(" ".join(segments), add_special_tokens=False)
        ids = np.array(e.ids, "<u4")
        first = np.cumsum([0, *(len(s) + 1 for s in segments)])
        cuts = np.searchsorted(np.array([o[0] for o in e.offsets], "i8"), first) * 4
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    # A word of small Latin letters is one piece for the pre-tokenizer; the model takes it as the byte-level alphabet writes it.
    bytelevel = ByteLevel(add_prefix_space=False, use_regex=False)
    latin = re.compile(r"[a-zß-öø-ÿ]+").fullmatch
    written = str.maketrans({c: bytelevel.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c.isalpha()})
    tokenize = tokenizer.model.tokenize

    def encode_all(segments: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(segments)
        plain, ids, counts, at = [], [], [], []
        for k, s in enumerate(segments):
            if latin(s):
                got = tokenize(s if s.isascii() else s.translate(written))
                ids += [t.id for t in got]
                counts.append(len(got))
                at.append(k)
            elif _plain(s):
                plain.append(k)
            else:
                out[k] = np.array(tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes()
        raw, x = np.array(ids, "<u4").tobytes(), 0
        for k, n in zip(at, counts, strict=True):
            out[k] = raw[x : x + 4 * n]
            x += 4 * n
        for x in range(0, len(plain), TOGETHER):
            block = plain[x : x + TOGETHER]
            for k, got in zip(block, together([segments[k] for k in block]), strict=True):
                out[k] = got
        return out

    return SegmentEncoder(latin, _pieces, encode_all, _spaced)


def ended(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some texts with ``END`` behind each text's, and the new bounds."""
    return np.insert(ids, at[1:], END), at + np.arange(len(at))
