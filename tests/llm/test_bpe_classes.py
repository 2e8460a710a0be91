"""Every code point, alone and between letters and digits, against the library."""

import public_tokenizers
import tiktoken

from tessera.llm import bpe


def test_all_code_points():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    own, ours = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe.Encoder(ranks)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4096):
        part = points[at : at + 4096]
        text = "\n".join(f"{c} a{c}b 1{c}2" for c in part)
        (ids, _), = ours.encode([text])
        assert ids == own.encode_ordinary(text), hex(at)
