"""Operator 10, secret scans: rule spans plus a token-efficiency test.

Rules find assignments, access keys and long hex strings. The test adds strings that a byte-pair vocabulary
spells with few characters per token: text that the vocabulary was made for takes four or more characters per
token, random keys about one and a half. Known digests (hex of the usual lengths), UUIDs and plain numbers are
excluded before the test, and a hit must not overlap a rule span. One document is one row; nothing is shuffled.

Defined results: NULL and empty texts have no spans; repeated rows give repeated results; an empty table gives
an empty result. The vocabulary file is read where it lies on each executor; its path is a parameter.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common as C

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pre-tokeniser of the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Strings are spelled in pieces of so many characters, since the merge search grows with the square of a piece.
PIECE = 256

#: Rule kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_NAMED = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Strings that the efficiency test looks at, and those it leaves out.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", re.ASCII)
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
KNOWN = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[0-9+/_=-]+|[_=+/-]+", re.ASCII)


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of the kind, end) of the rule matches, code points, end exclusive."""
    found = []
    low = text.lower()
    if any(k in low for k in _NAMED):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


@lru_cache(maxsize=2)
def vocabulary(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("secrets", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def is_known(s: str) -> bool:
    """Digests of the usual lengths, UUIDs and numbers: identifiers, not secrets."""
    m = KNOWN.fullmatch(s)
    return bool(m) and (not re.fullmatch("[0-9a-fA-F]+", s) or len(s) in DIGEST_LENGTHS or s.isdigit())


def n_tokens(s: str, encoding) -> int:
    return sum(len(encoding.encode_ordinary(s[i : i + PIECE])) for i in range(0, len(s), PIECE))


def inefficient(text: str, encoding, max_chars_per_token: float) -> list[tuple[int, int]]:
    """Spans of strings that take few characters per token."""
    out = []
    for m in CANDIDATE.finditer(text):
        s = m[0]
        if not is_known(s) and len(s) < max_chars_per_token * n_tokens(s, encoding):
            out.append((m.start(), m.end()))
    return out


def joined(spans: list[tuple[int, int, int]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find_secrets(docs: DataFrame, vocabulary_path: str = VOCABULARY, max_chars_per_token: float = 2.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: rule counts, digest of the rule spans, all spans (kind ``random`` for the test's)."""
    kinds = (*KINDS, "random")
    names = ["n_assign", "n_access", "n_hex"]
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_random bigint"

    def run(batches):
        encoding = vocabulary(vocabulary_path)
        for b in C.pieces(batches, "text"):
            rows: list[list] = [[] for _ in range(6)]
            for text in b.column("text").to_pylist():
                base = rule_spans(text or "")
                extra = [(a, 3, z) for a, z in inefficient(text or "", encoding, max_chars_per_token) if not any(s < z and a < e for s, _, e in base)]
                values = [*(sum(k == i for _, k, _ in base) for i in range(3)), hashlib.sha256(joined(base, kinds).encode()).hexdigest(), joined(base + extra, kinds), len(extra)]
                for column, v in zip(rows, values):
                    column.append(v)
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(r, t) for r, t in zip(rows, types))], names=["doc_id", *names, "base_sha256", "spans", "n_random"])

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)


def op10_token_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(C.read_documents(spark, sf_dir))
