"""Byte-level BPE vocabularies, read from a tokenizer file given by path."""

from __future__ import annotations

import json


def vocabulary_file(name: str) -> str:
    """Path of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes for the letters from
    U+0100 on, in ascending order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


#: How a byte-level vocabulary cuts text before merging (fixed pattern of the format).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def is_plain_byte_bpe(spec: dict) -> bool:
    """Whether a file asks for nothing beyond byte letters, SPLIT and merges by rank."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    return (
        model.get("type") == "BPE"
        and not any(model.get(k) for k in odd)
        and spec.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and not pre.get("add_prefix_space")
        and pre.get("use_regex", True)
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def merges_of(spec: dict) -> list[tuple[str, str]]:
    return [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]


def encoder(path: str):
    """``texts -> list of id lists`` as the library for this file gives them, special strings
    inside texts included.

    A plain byte-level file whose ids are its merge ranks goes to ``tiktoken``, which gives the
    same ids at four times the speed; any other file goes to ``tokenizers``.
    """
    spec = load(path)
    if is_plain_byte_bpe(spec):
        back = {letter: b for b, letter in enumerate(byte_letters())}
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ordered = [vocab.get(a + b) for a, b in merges_of(spec)]
        if ordered == list(range(256, 256 + len(ordered))):
            import tiktoken

            ranks = {bytes(back[c] for c in t): i for t, i in vocab.items() if t not in special}
            coder = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
            return lambda texts: [coder.encode(t, allowed_special="all") for t in texts]
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    return lambda texts: [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
