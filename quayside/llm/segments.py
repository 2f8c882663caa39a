"""Byte-level BPE of whole texts: by a twin of the vocabulary, or through a worker's cache of encoded segments.

A byte-level tokenizers file whose ids follow its merges says the same as a rank file, which tiktoken
encodes several times faster. Texts of characters that both libraries class alike take that way; all others
are encoded by tokenizers, segment by segment:

A space between two characters that are no white space always starts a new pre-token, and what is
matched from there depends only on what follows. Text cut at such spaces is therefore encoded
segment by segment with the very ids of the whole, and most segments are words met before.
"""

from __future__ import annotations

import base64
import contextlib
import json
import os
import re
from collections.abc import Callable

import numpy as np

#: Segments of a generation of a worker's cache, and the longest one kept, in characters: tens of megabytes at most.
CACHE_SEGMENTS = 200_000
CACHE_CHARS = 32

#: Anything but letters, digits and signs long in Unicode, whose class no version or library disputes, or a run of
#: white space long enough to tire a backtracking matcher.
_ODD = re.compile(
    "[^\\t\\n\\r\\x20-\\x7e\u00a1-\u00ac\u00ae-\u024f\u0400-\u0481\u048a-\u0527\u2010-\u2027\u2030-\u205e\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]"
    "|[\\t\\n\\r ]{200}"
)
_DOUBLE = re.compile(r"\s(?:\s|\Z)")
_BREAK = re.compile(r"(?<=\S) (?=\S)")
_MADE: dict[tuple[str, str], SegmentEncoder] = {}

Encode = Callable[[list[str]], list[bytes]]


class SegmentEncoder:
    """`encode` gives the ids of texts; `leads` tells for every id whether its bytes begin with a space.

    `twin`, if there is one, gives the same ids for a text without anything `_ODD`.
    """

    def __init__(self, encode: Encode, leads: np.ndarray, twin: Callable[[str], bytes] | None = None):
        self.encode = encode
        self.leads = leads
        self.twin = twin
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        if self.twin is None:
            return self._by_segments(texts)
        odd = [i for i, t in enumerate(texts) if _ODD.search(t)]
        rest = dict(zip(odd, self._by_segments([texts[i] for i in odd]), strict=True)) if odd else {}
        return [rest[i] if i in rest else self.twin(t) for i, t in enumerate(texts)]

    def _by_segments(self, texts: list[str]) -> list[bytes]:
        parts = [_BREAK.split(t) if t[:1].isspace() or _DOUBLE.search(t) else t.split(" ") for t in texts]
        heads = self.encode([p[0] for p in parts])
        if len(self.known) > CACHE_SEGMENTS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing = [x for x in {x for p in parts for x in p[1:]} if x not in known]
        known.update((x, older[x]) for x in missing if x in older)
        known.update(self._fresh([x for x in missing if x not in older]))
        out = [h + b"".join([known[x] for x in p[1:]]) for h, p in zip(heads, parts, strict=True)]
        for x in missing:
            if len(x) > CACHE_CHARS:
                del known[x]
        return out

    def _fresh(self, segments: list[str]) -> dict[str, bytes]:
        """Ids of new segments, each after a space: encoded as one text, which falls apart at the ids that begin with one."""
        joined = [x for x in segments if " " not in x and not x[-1].isspace()]
        made: dict[str, bytes] = {}
        if joined:
            raw = self.encode(["".join([" " + x for x in joined])])[0]
            cuts = np.append(np.flatnonzero(self.leads[np.frombuffer(raw, "<u4")]) * 4, len(raw)).tolist()
            if len(cuts) == len(joined) + 1 and not cuts[0]:
                made = {x: raw[i:j] for x, i, j in zip(joined, cuts, cuts[1:], strict=False)}
        rest = [x for x in segments if x not in made]
        made.update(zip(rest, self.encode([" " + x for x in rest]), strict=True))
        return made


def _file(name_or_path: str) -> str:
    if os.path.sep in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def json_encoder(vocabulary: str) -> SegmentEncoder:
    """Encoder of a tokenizers file; strings of special tokens in a text are ordinary text."""
    key = ("json", vocabulary)
    if key not in _MADE:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(_file(vocabulary))
        tokenizer.encode_special_tokens = True

        def encode(texts: list[str]) -> list[bytes]:
            return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        words = tokenizer.get_vocab(with_added_tokens=True)
        space = tokenizer.pre_tokenizer.pre_tokenize_str(" ")[0][0]  # how the file writes the byte of a space
        leads = np.zeros(max(words.values()) + 1, bool)
        leads[[i for word, i in words.items() if word.startswith(space)]] = True
        _MADE[key] = SegmentEncoder(encode, leads, _twin(_file(vocabulary)))
    return _MADE[key]


def _letters() -> dict[str, int]:
    """How byte-level files write each byte: signs that can be seen as themselves, the others as letters from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def _twin(path: str) -> Callable[[str], bytes] | None:
    """Ids of a text by tiktoken, from a tokenizers file that says what a rank file could say; None for any other."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, before = file["model"], file.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        and not file.get("normalizer") and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    if not plain:
        return None
    byte, special = _letters(), {t["content"] for t in file.get("added_tokens", ())}
    ranks = {bytes(byte[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"][a + b] for a, b in merges]
    if len(ranks) != 256 + len(order) or any(x >= y for x, y in zip(order, order[1:], strict=False)):
        return None
    encoding = tiktoken.Encoding("twin", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: np.array(encoding.encode_ordinary(text), "<u4").tobytes()


def rank_encoding(vocabulary: str):
    """tiktoken encoding of a rank file, without special tokens."""
    import public_tokenizers
    import tiktoken

    with open(_file(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _by_rank(encoding) -> np.ndarray:
    leads = np.zeros(encoding.n_vocab, bool)
    for i in range(encoding.n_vocab):
        with contextlib.suppress(KeyError):  # a rank without token
            leads[i] = encoding.decode_single_token_bytes(i).startswith(b" ")
    return leads


_RANKED: dict[str, tuple] = {}


def rank_encoder(vocabulary: str) -> tuple[SegmentEncoder, object]:
    """Encoder of a rank file and its encoding, for decoding."""
    if vocabulary not in _RANKED:
        encoding = rank_encoding(vocabulary)

        def encode(texts: list[str]) -> list[bytes]:
            return [np.array(encoding.encode_ordinary(t), "<u4").tobytes() for t in texts]

        _RANKED[vocabulary] = (SegmentEncoder(encode, _by_rank(encoding)), encoding)
    return _RANKED[vocabulary]
