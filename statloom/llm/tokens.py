"""Token ids of texts, from the file of a public tokenizer.

Texts are encoded word by word, every distinct word once per task. That is exact for tokenizers that
drop white space before anything else; any other one gets whole texts.
"""

from __future__ import annotations

import json
from itertools import repeat

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

from statloom.llm.common import distinct_words, ragged

#: When a task has gathered so many words it forgets, before the next texts, those it has met only
#: in so few of them.
WORDS_KEPT, FORGOTTEN = 250_000, 2
_END, _BREAK = "\0", "\n"
#: Kinds of bytes: letter (and the break between words) 0, other printable ASCII 1, part of another character 2,
#: control 4, part of a letter from À to ÿ 8, of a sign among these 9.
_KINDS = np.full(256, 2, np.uint8)
_KINDS[:128] = [0 if chr(b).isalpha() or b == 10 else 1 if 0x20 < b < 0x7F else 4 for b in range(128)]
_KINDS[[0xC3, *range(0x80, 0xC0)]], _KINDS[[0x97, 0xB7]] = 8, 9


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[str, int]:
    """Letter by which byte-level vocabularies write each byte: itself if printable, else from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Encodes texts; made in each task, as it holds the words met so far."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        with open(path) as f:
            told = json.load(f)
        model, split = told["model"], (told.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.by_word = any(n.get("content") == " " for n in (told.get("normalizer") or {}).get("normalizers", []))
        self.by_word &= split[0].get("behavior") == "Removed" and bool(split[0].get("invert"))
        self.fast = None
        if self.by_word and model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>":
            self._merge_by_rank(model, split[0]["pattern"]["Regex"], {t["content"] for t in told["added_tokens"]})
        self._forget()

    def _merge_by_rank(self, model: dict, pattern: str, special: set[str]) -> None:
        """The same merges, run by a faster library: the end of a word is a byte of its own.

        It always merges first, as the pairs of a letter and the end have the lowest numbers.
        """
        vocab, letters = model["vocab"], _byte_letters()
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        if [vocab[m] for m in merged] != list(range(512, 512 + len(merged))):
            return
        ranks = {}
        for token, number in vocab.items():
            if token not in special:
                ended = token.endswith("</w>")
                raw = bytes(letters[c] for c in (token[:-4] if ended else token))
                ranks[raw + (b"\0" if ended else b"")] = number
        self.line = max(vocab.values()) + 1
        ranks[_BREAK.encode()] = self.line
        self.special = special
        self.pieces = regex.compile(pattern)
        # a run of letters is one piece, unless the pattern tries anything before that may begin with a letter
        before, runs, _ = pattern.partition("|[\\p{L}]+|")
        self.whole_runs = bool(runs) and all(a.startswith("'") for a in before.split("|"))
        self.closing = np.zeros(self.line + 1, bool)
        self.closing[[number for token, number in vocab.items() if token.endswith("</w>")]] = True
        self.fast = tiktoken.Encoding(
            "words", pat_str=r"[^\x00\n]+\x00|\n", mergeable_ranks=ranks, special_tokens={}
        )

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.met = np.zeros(0, np.int64)

    def _forget_rare(self) -> None:
        """Keeps the words that came again; all go if these are more than half."""
        kept = np.flatnonzero(self.met > FORGOTTEN)
        if len(kept) > WORDS_KEPT // 2:
            return self._forget()
        words = list(self.number)
        self.ids = self.ids[ragged(self.starts[kept], self.sizes[kept])]
        self.sizes = self.sizes[kept]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.met = np.zeros(len(kept), np.int64)
        self.number = {words[k]: i for i, k in enumerate(kept.tolist())}

    def _learn(self, words: list[bytes]) -> None:
        plain, letters = self._quick(words) if self.fast else np.zeros((2, len(words)), bool)
        slow = self.whole.encode_batch([words[i].decode() for i in np.flatnonzero(~plain).tolist()], add_special_tokens=False)
        made: list[np.ndarray] = [np.array(e.ids, np.uint32) for e in slow]
        ids, sizes = np.concatenate([np.zeros(0, np.uint32), *made]), np.zeros(len(words), np.int64)
        sizes[~plain] = [len(m) for m in made]
        starts = np.zeros(len(words), np.int64)
        starts[~plain] = np.cumsum(sizes[~plain]) - sizes[~plain]
        mixed = plain & ~letters
        if mixed.any():
            lines = _BREAK.encode().join([words[i] for i in np.flatnonzero(mixed).tolist()]).decode()
            flat = self._flat(self.pieces.sub(r"\g<0>" + _END, lines.lower()))
            ends = np.concatenate([np.flatnonzero(flat == self.line), [len(flat)]])
            begins = np.concatenate([[0], ends[:-1] + 1])
            starts[mixed], sizes[mixed] = begins + len(ids), ends - begins
            ids = np.concatenate([ids, flat])
        if letters.any():
            run = _END.encode().join([*(words[i] for i in np.flatnonzero(letters).tolist()), b""])
            flat = self._flat(run.decode().lower())
            ends = np.flatnonzero(self.closing[flat]) + 1
            begins = np.concatenate([[0], ends[:-1]])
            starts[letters], sizes[letters] = begins + len(ids), ends - begins
            ids = np.concatenate([ids, flat])
        self.starts = np.concatenate([self.starts, starts + len(self.ids)])
        self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words)), strict=True))

    def _flat(self, marked: str) -> np.ndarray:
        return np.array(self.fast.encode_ordinary(marked), np.uint32)

    def _quick(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Which words the faster library may encode (printable Latin letters, no special token), and
        which of them are one piece as they have letters alone."""
        blob = _BREAK.encode().join([*words, b""])
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes + 1) - sizes - 1
        kinds = np.bitwise_or.reduceat(_KINDS[np.frombuffer(blob, np.uint8)], starts)
        plain = (kinds & 6) == 0
        for i in np.flatnonzero(plain & (sizes > 256)).tolist():
            plain[i] = len(words[i].decode()) <= 256
        special = [s.encode() for s in self.special if s.encode() in blob]
        for i in np.flatnonzero(plain).tolist() if special else ():
            plain[i] = not any(s in words[i] for s in special)
        return plain, plain & (kinds & 1 == 0) & self.whole_runs

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text."""
        if not self.by_word:
            made = [e.ids for e in self.whole.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *(np.array(m, np.uint32) for m in made)]), np.array(
                [len(m) for m in made], np.int64
            )
        distinct, at, counts = distinct_words(texts)
        if len(self.number) > WORDS_KEPT:
            self._forget_rare()
        found = np.fromiter(map(self.number.get, distinct, repeat(-1)), np.int64, len(distinct))
        if len(missing := np.flatnonzero(found < 0)):
            found[missing] = np.arange(len(self.number), len(self.number) + len(missing))
            self._learn([distinct[i] for i in missing.tolist()])
        which = found[at]
        self.met = np.concatenate([self.met, np.zeros(len(self.number) - len(self.met), np.int64)])
        self.met += np.bincount(which, minlength=len(self.met))
        sizes = self.sizes[which]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(counts)
        return self.ids[ragged(self.starts[which], sizes)], upto[ends] - upto[ends - counts]

    def encode_ended(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """The same with the id ``end`` behind each text."""
        ids, counts = self.encode(texts)
        return np.insert(ids, np.cumsum(counts), np.uint32(end)), counts + 1
