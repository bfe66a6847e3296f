"""Token ids of whole texts, exactly as the tokenizers library gives them.

Byte-level BPE merges within pre-tokens only, and a blank that a visible character follows always
opens a pre-token. Texts are therefore cut before such blanks, a distinct piece is encoded by the
library once as long as a worker remembers it, and a text's ids are those of its pieces in order. Arrow
cuts the texts and finds the distinct pieces of a batch; their ids are put in place as arrays. Texts
with another kind of white space after a blank, or with a special string, are encoded whole.

A piece is given without its blank; one that opens its text is given after a NUL instead.
"""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A blank before anything that some definition calls white space, or before the end.
UNSAFE = re.compile("[ ](?=[\\s\x1c-\x1f\x85᠎​⁠﻿]|$)")
MARKS = ".,;:!?#*$%&|<>"
REMEMBERED = 900_000
OPENING = "\0"


def worker_memory() -> dict:
    """A dictionary that lives as long as the Python worker, from task to task."""
    name = "basketry_worker_memory"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def default_path() -> str:
    """The vocabulary that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Memory(dict):
    """Ids by piece; asked for a piece that it lacks, it gives None and notes the piece."""

    def __init__(self):
        self.lacking: set[str] = set()

    def __missing__(self, piece):
        self.lacking.add(piece)


def parts_of(piece: str) -> list[str] | None:
    """The pieces of a piece: cut at single line ends, and before the last marks after a letter or digit.

    None if there is nothing to cut.
    """
    if "\n" not in piece:
        word = piece.rstrip(MARKS)
        if len(word) < len(piece) and word[-1:].isalnum():
            return [word, OPENING + piece[len(word) :]]
        return None
    opened = piece.startswith(OPENING)
    lines = piece[opened:].split("\n")
    if not all(
        line and not line[-1].isspace() and (not at or not line[0].isspace())
        for at, line in enumerate(lines)
    ):
        return None
    parts = []
    for at, line in enumerate(lines):
        own = OPENING + line if at or opened else line
        parts += [OPENING + "\n"] * (at > 0)
        parts += parts_of(own) or [own]
    return parts


class Encoder:
    """Ids of texts, with a bounded memory of pieces met before: about `remembered` at most."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        memory = worker_memory()
        if path not in memory:
            tokenizer = Tokenizer.from_file(path)
            memory[path] = (tokenizer, Memory(), blank_tokens(tokenizer))
        self.tokenizer, self.known, blanks = memory[path]
        added = self.tokenizer.get_added_tokens_decoder()
        plain = [k for k, t in added.items() if not (t.lstrip or t.rstrip or t.single_word)]
        self.special = re.compile("|".join(re.escape(t.content) for t in added.values()) or "(?!)")
        self.between = min(plain, default=None)
        self.cuttable = (
            type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel"
            and not self.tokenizer.pre_tokenizer.add_prefix_space
            and self.tokenizer.normalizer is None
            and len(plain) == len(added)
        )
        # In runs of pieces no special string may come about over a blank.
        apart = not any(" " in t.content for t in added.values())
        self.blanks = blanks if self.cuttable and apart else None

    def whole(self, text: str) -> bool:
        """Whether pieces of the text may not encode alike alone and in the text."""
        return bool(
            not self.cuttable
            or OPENING in text
            or UNSAFE.search(text)
            or self.special.search(text)
        )

    def pieces(self, text: str | None) -> list[str]:
        """The text cut into pieces that encode alike alone and in the text."""
        if not text:
            return []
        if self.whole(text):
            return [OPENING + text]
        pieces = text.split(" ")
        if not pieces[0]:
            return pieces[1:]
        pieces[0] = OPENING + pieces[0]
        return pieces

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; null counts as empty."""
        if len(self.known) > self.remembered:
            self.known.clear()
        # Texts as they are cut at blanks: the first piece of each without its blank or after a NUL.
        cut: list[str | None] = []
        alone: list[tuple[int, str]] = []
        for at, text in enumerate(texts):
            if not text:
                cut.append(None)
            elif self.whole(text):
                cut.append(None)
                alone.append((at, OPENING + text))
            else:
                cut.append(text[1:] if text[0] == " " else OPENING + text)
        lists = pc.split_pattern(pa.array(cut, pa.large_string()), " ")
        coded = pc.dictionary_encode(lists.flatten())
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.__getitem__, pieces))
        whole = [self.known[piece] for _, piece in alone]
        if self.known.lacking:
            self.learn()
            ids = list(map(self.known.__getitem__, pieces))
            whole = [self.known[piece] for _, piece in alone]

        flat = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(sizes) - sizes
        code = coded.indices.to_numpy()
        size = sizes[code]
        ends = np.concatenate([[0], np.cumsum(size)])
        data = flat[np.repeat(first[code] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        # A null has an empty list of pieces.
        edges = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
        edges = (4 * ends[edges]).tolist()
        out = [data[a:b] for a, b in zip(edges, edges[1:])]
        for (at, _), own in zip(alone, whole):
            out[at] = own
        return out

    def lengths(self, pieces: list[str]) -> list[int]:
        """How many tokens each piece has."""
        if len(self.known) > self.remembered:
            self.known.clear()
        for piece in pieces:
            self.known[piece]
        self.learn()
        return [len(self.known[piece]) // 4 for piece in pieces]

    def learn(self) -> None:
        """Encodes the pieces that were asked for and lacking."""
        pieces, self.known.lacking = self.known.lacking, set()
        known, cut, new = self.known, {}, set()
        for piece in pieces:
            if piece[0] != OPENING and "\n" not in piece:
                word = piece.rstrip(MARKS)
                if len(word) < len(piece) and word[-1:].isalnum():
                    tail = OPENING + piece[len(word) :]
                    cut[piece] = (word, tail)
                    new.add(word)
                    new.add(tail)
                else:
                    new.add(piece)
                continue
            # A text with a special string is one piece, which opens it.
            whole = piece[0] == OPENING and (not self.cuttable or self.special.search(piece))
            parts = None if whole else parts_of(piece)
            if parts:
                cut[piece] = parts
                new.update(parts)
            else:
                new.add(piece)
        self._encode([piece for piece in new if piece not in known])
        for piece, parts in cut.items():
            known[piece] = b"".join([known[part] for part in parts])

    def _encode(self, pieces: list[str]) -> None:
        if self.blanks is not None:
            opening = [piece for piece in pieces if piece[0] == OPENING]
            pieces = opening + self._encode_runs([p for p in pieces if p[0] != OPENING])
        texts = [p[1:] if p[0] == OPENING else " " + p for p in pieces]
        joined = self.between is not None
        alone = [
            at
            for at, piece in enumerate(pieces)
            if not joined or (piece[0] == OPENING and self.special.search(piece))
        ]
        for at in range(0, len(alone), 5_000):
            some = alone[at : at + 5_000]
            found = self.tokenizer.encode_batch_fast(
                [texts[k] for k in some], add_special_tokens=False
            )
            for k, e in zip(some, found):
                self.known[pieces[k]] = np.array(e.ids, "<u4").tobytes()
        if not joined:
            return
        # Many pieces in one call, with a special token between them: less work than a call each.
        between = self.tokenizer.id_to_token(self.between)
        apart = set(alone)
        rest = [k for k in range(len(pieces)) if k not in apart]
        for at in range(0, len(rest), 20_000):
            some = rest[at : at + 20_000]
            runs = [some[k : k + 200] for k in range(0, len(some), 200)]
            found = self.tokenizer.encode_batch_fast(
                [between.join([texts[k] for k in run]) for run in runs], add_special_tokens=False
            )
            for run, e in zip(runs, found):
                ids = np.array(e.ids, "<u4")
                ends = (np.append(np.flatnonzero(ids == self.between), len(ids)) * 4).tolist()
                data, begin = ids.tobytes(), 0
                for k, end in zip(run, ends):
                    self.known[pieces[k]] = data[begin:end]
                    begin = end + 4

    def _encode_runs(self, pieces: list[str]) -> list[str]:
        """Pieces with their blanks as one text: each begins at the token that begins with a blank.

        Gives the pieces of runs that have another number of such tokens.
        """
        left: list[str] = []
        for at in range(0, len(pieces), 20_000):
            some = pieces[at : at + 20_000]
            runs = [some[k : k + 200] for k in range(0, len(some), 200)]
            found = self.tokenizer.encode_batch_fast(
                [" " + " ".join(run) for run in runs], add_special_tokens=False
            )
            for run, e in zip(runs, found):
                ids = np.array(e.ids, "<u4")
                starts = np.flatnonzero(self.blanks[ids]) * 4
                if len(starts) != len(run):
                    left += run
                    continue
                data, edges = ids.tobytes(), [*starts.tolist(), 4 * len(ids)]
                self.known.update(zip(run, [data[a:b] for a, b in zip(edges, edges[1:])]))
        return left


def blank_tokens(tokenizer) -> np.ndarray:
    """By id, whether the token has a blank at its begin."""
    tokens = tokenizer.get_vocab(with_added_tokens=False)
    out = np.zeros(max(tokens.values(), default=0) + 1, bool)
    out[[at for token, at in tokens.items() if token.startswith("\u0120")]] = True
    return out


def small_batches(batch, most_bytes: int = 4_000_000):
    """An Arrow batch in runs whose texts make about `most_bytes`, so that memory stays bounded."""
    column = batch.column("text")
    sizes = np.array([len(v.as_buffer()) if v.is_valid else 0 for v in column], np.int64)
    at = 0
    while at < len(column):
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), most_bytes)))
        yield batch.slice(at, end - at)
        at = end
