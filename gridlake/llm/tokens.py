"""Byte-level BPE of a given vocabulary over whole texts."""

import json
import re

import numpy as np

#: The pattern that splits text before the merges, as published with the vocabulary (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that every Unicode version puts in the same class; texts with others take the slower path.
UNSURE = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ‐-‧]")


def byte_ranks(path: str) -> dict[bytes, int]:
    """Tokens of a tokenizer file as bytes, with their ids, which follow the order of the merges.

    Added tokens are left out.
    """
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    added = {t["content"] for t in data["added_tokens"]}
    return {bytes(byte_of[c] for c in t): i for t, i in data["model"]["vocab"].items() if t not in added}


class Encoder:
    """Token ids equal to `Tokenizer.encode(text, add_special_tokens=False)` of the file at `path`.

    The same merges run in a faster library; texts with rare characters or added tokens go through `tokenizers`
    itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=byte_ranks(path), special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if (text.isascii() or not UNSURE.search(text)) and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
