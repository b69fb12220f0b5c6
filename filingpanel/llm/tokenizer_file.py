"""What a byte-pair tokenizer file says: symbols, merge ranks, normalisation, splitting, decoding.

Only the file is read here. How its merges are applied is the matter of ``token_counts`` (heap and
linked list) and ``transducer`` (bounded lookahead).
"""

from __future__ import annotations

import json
import unicodedata

import regex

from filingpanel.llm.common import digest, kept

#: White space as regular expressions of the tokenizers library see it (Unicode White_Space).
SPACES = "\t-\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

#: The published split of byte-level vocabularies without a pattern of their own.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A file beyond this size is refused: it is broadcast to all executors.
MAX_FILE_BYTES = 64 << 20


def read_file(path: str) -> str:
    with open(path, encoding="utf-8") as source:
        text = source.read(MAX_FILE_BYTES + 1)
    if len(text) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    return text


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [chars[b] for b in range(256)]


def _compiled(pattern: str) -> regex.Pattern:
    # \s of the library is White_Space; Python's also takes the four separators 1C to 1F.
    inside = pattern.replace(r"[^\s", f"[^{SPACES}")
    return regex.compile(inside.replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]"))


class TokenizerFile:
    """A parsed tokenizer file: byte-level BPE, with or without an end-of-word suffix."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError("only byte-level BPE files are known")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}  # by pair: the rank of its merge, and what it makes
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            key = self.vocab[left], self.vocab[right]
            self.ranks[key] = rank, self.vocab[left + right]
        self.added: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        specials = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.added.items()}
        chars = byte_alphabet()
        self.byte_of = {c: b for b, c in enumerate(chars)}
        # A symbol that the vocabulary lacks is left out, as the library does without an unknown token.
        self.inner = [self.vocab.get(c) for c in chars]
        self.last = [self.vocab.get(c + self.suffix) for c in chars]
        self.steps = self._normalizers(spec.get("normalizer"))
        self.pattern, self.drops_spaces = self._splitter(spec["pre_tokenizer"])
        self._bytes: dict[int, bytes] = {}
        self.byte_decoder = (spec.get("decoder") or {}).get("type") == "ByteLevel"

    @staticmethod
    def _normalizers(spec: dict | None) -> list[str]:
        parts = [] if spec is None else spec["normalizers"] if spec["type"] == "Sequence" else [spec]
        names = []
        for part in parts:
            if part["type"] == "Replace" and part["pattern"] == {"Regex": "\\s+"} and part["content"] == " ":
                continue  # pieces never hold white space: it is cut at before
            if part["type"] not in ("NFC", "Lowercase"):
                raise ValueError(f"unknown normalizer {part['type']}")
            names.append(part["type"])
        return names

    @staticmethod
    def _splitter(spec: dict) -> tuple[regex.Pattern, bool]:
        parts = spec["pretokenizers"] if spec["type"] == "Sequence" else [spec]
        split = next((p for p in parts if p["type"] == "Split"), None)
        if any(p["type"] not in ("Split", "ByteLevel") or p.get("add_prefix_space") for p in parts):
            raise ValueError("unknown pre-tokenizer")
        if split is None:
            return _compiled(BYTE_LEVEL_SPLIT), False
        if split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("unknown split")
        return _compiled(split["pattern"]["Regex"]), True

    def normalized(self, piece: str) -> str:
        for step in self.steps:
            if step == "NFC":
                piece = unicodedata.normalize("NFC", piece)
            else:  # letter by letter: no rule for a final sigma
                piece = piece.replace("Σ", "σ").lower()
        return piece

    def bytes_of(self, token: int) -> bytes:
        """What a token stands for; a special token, or a part of an unknown alphabet, for its own name."""
        found = self._bytes.get(token)
        if found is None:
            name, byte_of = self.names.get(token, ""), self.byte_of
            found = bytes([byte_of[c] for c in name]) if all(c in byte_of for c in name) else name.encode()
            self._bytes[token] = found
        return found

    def symbols(self, word: str) -> list[int]:
        """The initial symbols of a word: one for each UTF-8 byte, the last with the suffix."""
        data = word.encode("utf-8", "surrogatepass")
        inner = self.inner
        found = [inner[b] for b in data]
        if found and self.suffix:
            found[-1] = self.last[data[-1]]
        return found if None not in found else [x for x in found if x is not None]


def tokenizer_of(text: str) -> TokenizerFile:
    """The parsed file; kept by a worker process."""
    return kept(("tokenizer", digest(text)), lambda: TokenizerFile(text))
