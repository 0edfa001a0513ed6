"""Token ids of a public byte-level vocabulary, whole texts at a time.

The ids are those of the `tokenizers` library for the vocabulary file. That library makes some
2.5 MB a second and core; the same vocabulary as ranks in `tiktoken` makes 12 MB and gives the
same ids. So texts of Latin-1 characters without huge runs, for which both libraries' character
classes are the same by definition, go to the fast one, and all others to `tokenizers` itself.
So do texts that hold the string of an added token, as it has an id of its own there.
"""

from __future__ import annotations

import base64
import json
import re

import numpy as np

VOCABULARY = "byte_bpe_50k"
# A run this long without a break makes the fast library's merge loop slow.
_LONG_RUN = re.compile(r"\S{4000}|\s{4000}")


def vocabulary_path(kind: str) -> str:
    """Path of the public vocabulary file, `json` or `tiktoken`."""
    import public_tokenizers
    return public_tokenizers.path(f"{VOCABULARY}.{kind}")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def read_added(path: str) -> dict[str, int]:
    """Content and id of the tokens that the vocabulary file adds to its merges."""
    with open(path, encoding="utf-8") as file:
        return {token["content"]: token["id"] for token in json.load(file).get("added_tokens") or []}


class Encoder:
    """Encodes texts; made once per task."""

    def __init__(self, json_path: str | None = None, ranks_path: str | None = None):
        import public_tokenizers
        import tiktoken

        self.json_path = json_path or vocabulary_path("json")
        ranks = read_ranks(ranks_path or vocabulary_path("tiktoken"))
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.full = None
        added = read_added(self.json_path)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        # Bytes of each id.
        sizes = {rank: len(token) for token, rank in ranks.items()}
        sizes |= {i: len(content.encode("utf-8")) for content, i in added.items()}
        self.id_bytes = np.zeros(max(sizes) + 1, np.int64)
        self.id_bytes[list(sizes)] = list(sizes.values())

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as unsigned 32-bit numbers, added tokens (`<|endoftext|>`) included."""
        if not text:
            return np.empty(0, np.uint32)
        try:
            text.encode("latin-1")
            plain = ((len(text) < 4000 or not _LONG_RUN.search(text))
                     and not (self.added and self.added.search(text)))
        except UnicodeEncodeError:
            plain = False
        if plain:
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        return np.array(self.encode_full(text), np.uint32)

    def encode_full(self, text: str) -> list[int]:
        if self.full is None:
            from tokenizers import Tokenizer
            self.full = Tokenizer.from_file(self.json_path)
        return self.full.encode(text, add_special_tokens=False).ids
