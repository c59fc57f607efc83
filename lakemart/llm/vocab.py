"""Public tokenizers inside Spark tasks: loaded once in a Python worker, with what is known about their context."""

from __future__ import annotations

import json
import os
import string
import struct
from functools import lru_cache

import numpy as np

# Words whose ids a worker remembers. Beyond that it forgets them all: a matter of speed alone.
REMEMBERED = 1_000_000
UINT32 = np.dtype("<u4")
# Marks at the end of a word: a run of them is encoded by itself. The apostrophe may belong to letters.
MARKS = string.punctuation.replace("'", "")
# The last character of Latin letters that are composed as far as they can be.
LATIN = "\u024f"

# Fixed value: a normalizer and splitter for which a blank ends every token and leaves no trace.
BLANK_FREE = {
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
    "split": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}


def _config(tokenizer) -> dict:
    config = json.loads(tokenizer.to_str())
    config["model"] = {k: v for k, v in config["model"].items() if k not in ("vocab", "merges")}
    return config


def blank_free(tokenizer) -> bool:
    """Whether each stretch between blanks is encoded by itself, whatever stands around it."""
    config = _config(tokenizer)
    pre = (config["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        (config["normalizer"] or {}).get("normalizers") == BLANK_FREE["normalizers"]
        and len(pre) == 2
        and pre[0] == {"type": "Split", "pattern": {"Regex": BLANK_FREE["split"]}, "behavior": "Removed", "invert": True}
        and pre[1].get("type") == "ByteLevel"
        and not pre[1].get("add_prefix_space")
        and not config["model"].get("dropout")
        and all(not t[k] for t in config["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )


class Words(dict):
    """Words and their ids as bytes, encoded when they are first asked for.

    A word is what stands between two blanks. Letters are encoded apart from the marks at their end, and Latin letters
    by their lower case, which the normalizer makes first; in both cases only if they are letters in lower case, too.
    Lower-case Latin letters are one piece, which the normalizer and the splitter leave as it is: the model alone
    encodes it. All else goes through the whole tokenizer.
    """

    def __init__(self, tokenizer):
        from tokenizers import pre_tokenizers

        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, word: str) -> bytes:
        core = word.rstrip(MARKS)
        low = core.lower()
        if not core.isalpha() or not low.isalpha():
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        elif core != word:
            found = self[core] + self[word[len(core) :]]
        elif max(low) > LATIN or max(core) > LATIN:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        elif low != core:
            found = self[low]
        else:
            piece = core if core.isascii() else self.bytes.pre_tokenize_str(core)[0][0]
            ids = [token.id for token in self.model.tokenize(piece)]
            found = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = found
        return found


class JsonCodec:
    """A tokenizers file. No added, begin or end tokens, no truncation, no padding."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = blank_free(self.tokenizer)
        self.words = Words(self.tokenizer)

    def with_offsets(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the begin and end of each token in characters."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        offsets = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)
        return np.array(found.ids, dtype=UINT32), offsets[:, 0], offsets[:, 1]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, dtype=UINT32).tobytes() for e in found]
        if len(self.words) > REMEMBERED:
            self.words.clear()
        self.words[""] = b""
        # Blanks separate: the library encodes each different word once.
        return [b"".join(map(self.words.__getitem__, t.replace("\n", " ").split(" "))) for t in texts]


class PieceCodec:
    """A sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def with_offsets(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pieces = self.model.encode(text, return_type="proto").pieces
        table = np.array([(p.id, p.begin, p.end) for p in pieces], dtype=np.int64).reshape(-1, 3)
        return table[:, 0].astype(UINT32), table[:, 1], table[:, 2]

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, dtype=UINT32).tobytes() for ids in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=4)
def codec(path: str) -> JsonCodec | PieceCodec:
    return PieceCodec(path) if path.endswith(".model") else JsonCodec(path)


def batches_of(values: list[str], characters: int = 1 << 20):
    """Consecutive runs of texts of about a million characters: bounded memory inside a batch."""
    run, size = [], 0
    for v in values:
        run.append(v)
        size += len(v)
        if size >= characters:
            yield run
            run, size = [], 0
    if run:
        yield run
