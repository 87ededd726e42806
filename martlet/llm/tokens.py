"""Token ids of whole texts by a byte-level BPE vocabulary file."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in byte-level vocabularies: a fixed rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """Encoder of the file's own vocabulary and added tokens. Merges there are in the order of the ids."""
    letters = _byte_letters()
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    ranks = {
        bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(text: str, path: str = VOCABULARY, added: bool = False) -> np.ndarray:
    """Ids of a text. Strings of the file's added tokens are ordinary text, or with ``added`` one id each.

    With ``added`` the ids are those of the ``tokenizers`` library with add_special_tokens=False.
    """
    own = encoder(path)
    if added and any(token in text for token in own.special_tokens_set):
        return np.array(own.encode(text, allowed_special="all"), "<u4")
    return np.array(own.encode_ordinary(text), "<u4")
