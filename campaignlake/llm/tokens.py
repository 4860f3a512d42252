"""Byte-level BPE from a public tokenizer file, for use inside tasks.

``load(path)`` reads a ``tokenizers`` JSON file and returns a function from a
text to its ids (no special tokens are added, and their strings in a text are
ordinary text).  Where the file is plain byte-level BPE whose ids follow the
order of its merges, the same ids come from the faster ``tiktoken`` engine;
any other file runs in ``tokenizers`` itself.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np

DEFAULT = "byte_bpe_50k.json"

# Fixed value: the pre-token pattern of byte-level BPE files with ``use_regex``.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def resolve(path: str | None) -> str:
    """A tokenizer file: a path, or by default the one among the installed public files."""
    if path is None:
        import public_tokenizers
        return str(public_tokenizers.path(DEFAULT))
    return path


def byte_letters() -> dict[str, int]:
    """The letters that byte-level files write for bytes: printable ones stand for
    themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks for the fast engine, or None if the file is of another kind."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and spec.get("normalizer") is None
             and split.get("type") == "ByteLevel" and split.get("use_regex", True)
             and not split.get("add_prefix_space") and not model.get("dropout")
             and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))
    special = {t["content"] for t in spec.get("added_tokens", [])}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    letters = byte_letters()
    if not plain or any(c not in letters for t in vocab for c in t):
        return None
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    if [vocab.get(a + b) for a, b in merges] != list(range(256, 256 + len(merges))):
        return None
    return {bytes(letters[c] for c in t): i for t, i in vocab.items()}


def load(path: str | None = None) -> Callable[[str], np.ndarray]:
    path = resolve(path)
    with open(path, encoding="utf-8") as f:
        ranks = merge_ranks(json.load(f))
    if ranks is not None:
        import tiktoken
        engine = tiktoken.Encoding("file", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})
        return lambda text: engine.encode_to_numpy(text, disallowed_special=())
    from tokenizers import Tokenizer
    engine = Tokenizer.from_file(path)
    engine.encode_special_tokens = True
    return lambda text: np.array(engine.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
