"""Byte-level BPE encoding inside tasks.

Encodes with a public vocabulary file of merge ranks; the ids equal those of the
``tokenizers`` file of the same vocabulary (tests compare the two). The added tokens of that
file (the .json beside the ranks) are split off first wherever their string stands in a
text, and have its ids. A text with a run of ``LONG_BLANKS`` blanks or more, for which the
pattern of the fast encoder recurses too deep, is encoded by the ``tokenizers`` file itself.
"""

from __future__ import annotations

import base64
import json
import os
import re

_ENCODERS: dict = {}
LONG_BLANKS = 100_000


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(ranks_path: str) -> dict[str, int]:
    """The tokens that the vocabulary's ``tokenizers`` file adds to the merges: text to id. None
    without such a file."""
    path = os.path.splitext(ranks_path)[0] + ".json"
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    odd = [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"]]
    if odd:
        raise ValueError("added tokens that take blanks or whole words only: %s" % odd)
    return {t["content"]: t["id"] for t in added}


def encoder(ranks_path: str):
    """One encoder per Python worker and file: (encode function, byte length of each id)."""
    if ranks_path not in _ENCODERS:
        import numpy as np
        import public_tokenizers
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        added = added_tokens(ranks_path)
        e = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
        sizes = np.zeros(max([*ranks.values(), *added.values()]) + 1, np.int32)
        for piece, i in [*ranks.items(), *((t.encode(), i) for t, i in added.items())]:
            sizes[i] = len(piece)

        blanks, whole = re.compile(r"\s{%d}" % LONG_BLANKS), []

        def encode(text: str) -> list[int]:
            if len(text) >= LONG_BLANKS and blanks.search(text):
                if not whole:
                    from tokenizers import Tokenizer
                    whole.append(Tokenizer.from_file(os.path.splitext(ranks_path)[0] + ".json"))
                return whole[0].encode(text, add_special_tokens=False).ids
            if any(t in text for t in added):
                return e.encode(text, allowed_special="all")
            return e.encode_ordinary(text)
        _ENCODERS[ranks_path] = (encode, sizes)
    return _ENCODERS[ranks_path]
