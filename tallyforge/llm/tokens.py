"""Byte-level BPE ids of whole texts, as little-endian unsigned 32-bit values.

The ranks file holds the same vocabulary as ``byte_bpe_50k.json`` and gives the same ids (tested);
its library takes a third of the time.  It names no special tokens; the JSON file's are given here.

That library cannot take a very long run of white space, on which its pattern goes back too often; a text
with one is encoded from the JSON file.
"""

from __future__ import annotations

import base64
import os
import re
from array import array

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Special tokens of the JSON file of a vocabulary.
SPECIAL = {VOCABULARY: {"<|endoftext|>": 50256}}
#: The JSON file of a vocabulary, for texts with runs of white space of this length or longer.
WHOLE = {VOCABULARY: "byte_bpe_50k.json"}
LONG_BLANK = re.compile(r"\s{50000}")
END_OF_TEXT = (0).to_bytes(4, "little")


class Encoder:
    """Encodes texts in one task; ``vocabulary`` is a ranks file of the public tokenizers, or a path.

    With ``special`` the strings of special tokens get their ids, as the JSON file's tokenizer gives
    them; else they are ordinary text.
    """

    def __init__(self, vocabulary: str = VOCABULARY, special: bool = False):
        path = vocabulary if os.sep in vocabulary else public_tokenizers.path(vocabulary)
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._special = SPECIAL.get(vocabulary, {}) if special else {}
        self._whole, self._other = WHOLE.get(vocabulary), None
        self._model = tiktoken.Encoding(
            "given", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self._special
        )

    def ids(self, text: str) -> bytes:
        """Ids of a whole text; an empty text has none."""
        if self._whole and LONG_BLANK.search(text):
            return array("I", self._from_json().encode(text, add_special_tokens=False).ids).tobytes()
        if not self._special:
            return array("I", self._model.encode_ordinary(text)).tobytes()
        return array("I", self._model.encode(text, allowed_special="all")).tobytes()

    def _from_json(self) -> Tokenizer:
        if self._other is None:
            self._other = Tokenizer.from_file(public_tokenizers.path(self._whole))
            self._other.encode_special_tokens = not self._special
        return self._other
