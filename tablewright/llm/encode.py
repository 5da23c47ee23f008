"""Whole-text encoding with public tokenizer files, inside tasks.

Both vocabularies split a text into pieces before merging (at the latest at
white space), so the ids of a text are the ids of its space-separated pieces
put together. Each worker encodes a distinct piece once and remembers it over all
its tasks (a bounded memo, see ``encoder``); rare layouts, such as runs of blanks, stay inside one piece and
are encoded as they stand. A piece of plain letters, ASCII punctuation and single
line ends is cut further into runs of one kind, which both vocabularies split at,
so a word is encoded once whatever stands around it. Runs not known yet go to the
library many at a time, as one text; the ids tell where each run begins (a space
in its first token), ends (the word-end mark) or is parted from the next (a line
end), and if the number of runs does not come out they are encoded one by one. Texts that hold the literal of an added token (such as
``<|endoftext|>``), which the library takes out before it splits, are encoded whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

from tablewright.llm.common import kept

_MEMO_LIMIT = 1_000_000
# A space before one of these always starts a new piece of the byte-level split.
_PLAIN = "!-~¡-ɏЀ-ӿ"
_ODD_SPACE = re.compile(f" (?![{_PLAIN}])")
_SPLIT = re.compile(f" (?=[{_PLAIN}])")
# Letters with one-letter lower case, and ASCII punctuation without the apostrophe
# (both vocabularies know contractions).
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏЀ-ҁҊ-ӿ"
_MARKS = r"!-&(-/:-@\[-`{-~"
_RUNS = re.compile(f"[{_LETTERS}]+|[{_MARKS}]+|\n")
_CUTTABLE = re.compile(f"(?:[{_LETTERS}]+|[{_MARKS}]+|\n(?!\n))+")
_GROUP = 500


class Encoder:
    """``spaced``: the vocabulary keeps a space with the word after it (byte-level
    pieces); otherwise white space only separates words."""

    def __init__(self, name: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(public_tokenizers.path(name))
        added = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        self._added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.spaced = spaced
        self.dtype = np.dtype("<u2" if self._tok.get_vocab_size() <= 1 << 16 else "<u4")
        self._memo: dict[str, bytes] = {}
        vocab = self._tok.get_vocab()
        self._begins, self._ends = (np.zeros(max(vocab.values()) + 1, bool) for _ in range(2))
        for token, i in vocab.items():
            self._begins[i], self._ends[i] = token.startswith("\u0120"), token.endswith("</w>")
        self._line = vocab.get("\u010a")

    def pieces(self, text: str) -> list[str]:
        """Memo keys of the pieces. Byte-level: a key stands for itself after a
        space; one that starts with a space is the piece without that space."""
        if not self.spaced:
            return text.replace("\n", " ").split(" ")
        parts = _SPLIT.split(text) if _ODD_SPACE.search(text) else text.split(" ")
        parts[0] = " " + parts[0]
        return parts

    def _piece(self, key: str) -> str:
        if not self.spaced:
            return key
        return key[1:] if key[:1] == " " else " " + key

    def runs(self, key: str) -> list[str] | None:
        """Keys of the runs of one kind of a piece; None if it is not to be cut."""
        inner = key[:1] == " "      # byte-level: not after a space
        body = key[1:] if inner else key
        if not _CUTTABLE.fullmatch(body):
            return None
        found = _RUNS.findall(body)
        if self.spaced:
            if found[0] == "\n" and not inner:
                return None
            return [r if not i and not inner else " " + r for i, r in enumerate(found)]
        return [r.encode().lower().decode() for r in found]

    def _learn(self, keys: list[str]) -> None:
        """Remember pieces, one by one."""
        for at in range(0, len(keys), 4096):
            part = keys[at:at + 4096]
            for k, e in zip(part, self._tok.encode_batch_fast([self._piece(k) for k in part], add_special_tokens=False)):
                self._memo[k] = np.array(e.ids, self.dtype).tobytes()

    def _learn_runs(self, keys: list[str]) -> None:
        """Remember runs, many at a time."""
        inner = [k for k in keys if self.spaced and k[0] == " "]
        if " \n" in inner:
            inner.remove(" \n")
            self._learn([" \n"])
        for kind, sep in (([k for k in keys if not self.spaced or k[0] != " "], " "), (inner, "\n")):
            groups = [kind[i:i + _GROUP] for i in range(0, len(kind), _GROUP)]
            texts = [sep.join(k.lstrip(" ") for k in g) if sep == "\n" else
                     (" " if self.spaced else "") + " ".join(g) for g in groups]
            for group, e in zip(groups, self._tok.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(e.ids, np.int64)
                if sep == "\n":
                    cuts = np.flatnonzero(ids == self._line)
                    starts, ends = np.r_[0, cuts + 1], np.r_[cuts, len(ids)]
                elif self.spaced:
                    starts = np.flatnonzero(self._begins[ids])
                    ends = np.r_[starts[1:], len(ids)]
                else:
                    ends = np.flatnonzero(self._ends[ids]) + 1
                    starts = np.r_[0, ends[:-1]]
                if len(starts) != len(group) or (len(ids) and (starts[0] != 0 or ends[-1] != len(ids))):
                    self._learn(group)
                    continue
                raw, w = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
                for k, a, b in zip(group, (starts * w).tolist(), (ends * w).tolist()):
                    self._memo[k] = raw[a:b]

    def encode(self, texts) -> list[bytes]:
        """Ids of every text (None: no ids) as bytes of ``dtype``."""
        memo = self._memo
        if len(memo) > _MEMO_LIMIT:
            memo.clear()
        texts = [t or "" for t in texts]
        whole = {i for i, t in enumerate(texts) if self._added.search(t)}
        cut = [[] if i in whole else self.pieces(t) for i, t in enumerate(texts)]
        new = set().union(*cut).difference(memo)
        made = {k: self.runs(k) for k in new}
        self._learn_runs(list({r for rs in made.values() if rs for r in rs if r not in memo}))
        self._learn([k for k, rs in made.items() if not rs])
        for k, rs in made.items():
            if rs and k not in memo:
                memo[k] = b"".join([memo[r] for r in rs])
        get = memo.__getitem__
        return [self._whole(texts[i]) if i in whole else b"".join(map(get, ps)) for i, ps in enumerate(cut)]

    def _whole(self, text: str) -> bytes:
        return np.array(self._tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def batches(self, texts, chars: int = 4_000_000):
        """``encode`` over slices of at most about ``chars`` characters."""
        part, size = [], 0
        for t in texts:
            part.append(t)
            size += len(t or "")
            if size >= chars:
                yield from self.encode(part)
                part, size = [], 0
        if part:
            yield from self.encode(part)


def encoder(name: str, spaced: bool) -> Encoder:
    """The encoder of a vocabulary: the tasks of a Python worker share the tokenizer
    and the pieces met before, until the worker does other work (``kept``)."""
    return kept(("encoder", name, spaced), lambda: Encoder(name, spaced))


def as_uint32(ids: bytes, dtype: np.dtype) -> bytes:
    return np.frombuffer(ids, dtype).astype("<u4").tobytes()
