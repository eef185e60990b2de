"""Ids of plain texts from the byte ranks of a byte-level tokenizer file."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import public_tokenizers
import tiktoken

from millrace.llm.encoding import ID, byte_letters, id_bytes

# Characters that all libraries put into the same classes: Latin letters, ASCII, blanks.
_PLAIN = re.compile("[\\t-\\r -~\\xa0-\\u024f]*")


def ranked_id_bytes(path: str) -> Callable[[str], bytes]:
    """``id_bytes`` for a byte-level file, faster for texts of plain characters.

    If merges stand in the order of their results' ids, an id is the rank of its bytes, and a
    text's ids are those of the ranks alone. Texts with a special string or other
    characters, and files of another order, go through ``id_bytes``.
    """
    whole = id_bytes(path, keeps_space=True)
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    special = [token["content"] for token in parts["added_tokens"]]
    vocab, merges = parts["model"]["vocab"], parts["model"]["merges"]
    pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
    ids = [vocab[left + right] for left, right in pairs]
    prefixed = parts["pre_tokenizer"]["add_prefix_space"]
    if ids != sorted(set(ids)) or parts["normalizer"] is not None or prefixed:
        return whole
    letters = {letter: byte for byte, letter in byte_letters().items()}
    ranks = {bytes(letters[c] for c in token): n for token, n in vocab.items() if token not in special}
    model = tiktoken.Encoding(
        "ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )

    def encoded(text: str) -> bytes:
        if _PLAIN.fullmatch(text) is None or any(string in text for string in special):
            return whole(text)
        return np.array(model.encode_ordinary(text), dtype=ID).tobytes()

    return encoded
