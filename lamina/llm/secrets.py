"""Secret scan: patterns of known forms, and a token-efficiency test for random strings.

A run of ``MIN_RUN`` or more key characters that holds a letter is a finding of kind
``token`` when a public byte-pair vocabulary needs many tokens for it (at most
``max_ratio`` characters per token), unless it is a known digest or identifier (hex of a
digest's length, UUID, words or numbers joined by separators, each word one token or of more
than ``max_ratio`` characters per token) or overlaps a pattern's span. Case is no sign of
randomness, so runs and words count in the cheapest of three forms: as written, in lower case, and
by the words that capitals begin. Very long runs are counted in pieces of ``PIECE`` characters.

All scans take time linear in the text. Spans are code point offsets, end exclusive, of the whole match. Defined edge cases: a null
or empty text has no span; texts are scanned whole, however long; equal texts have equal
spans; spans of several kinds may overlap and are ordered by start, then kind; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

KINDS = ("assign", "access", "hex", "token")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: The shortest run that the efficiency test looks at, and the longest that the vocabulary gets at once.
MIN_RUN, PIECE = 16, 1024
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
DIGEST = re.compile(r"(?:0x)?([0-9a-f]+|[0-9A-F]+)")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: What stands between separators, and a part that a name can hold: a word with a short number, or a number.
PARTS, NAMED = re.compile(r"[A-Za-z0-9]+"), re.compile(r"[vV]?[0-9]+|[A-Za-z]+[0-9]{0,4}")
LETTERS, CAPITALS = re.compile(r"[A-Za-z]+"), re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[^A-Za-z]+|[A-Z]")

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_token long"


@lru_cache(maxsize=2)
def vocabulary(path: str):
    """The rank file's encoding, with the public pattern that splits text."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def size_in_tokens(run: str, path: str) -> int:
    """The fewest tokens of a run over its forms: as written, in lower case, split where capitals begin a word."""
    encode = vocabulary(path).encode_ordinary
    if len(run) > PIECE:
        return sum(size_in_tokens(run[k : k + PIECE], path) for k in range(0, len(run), PIECE))
    forms = [len(encode(run))]
    if not run.islower():
        forms.append(len(encode(run.lower())))
        words = CAPITALS.findall(run)
        if len(words) > 1 and len(run) >= 4 * len(words):
            forms.append(sum(len(encode(w)) for w in words))
    return min(forms)


def efficient(word: str, path: str, max_ratio: float) -> bool:
    n = size_in_tokens(word, path)
    return n == 1 or len(word) > max_ratio * n


def known(run: str, path: str, max_ratio: float) -> bool:
    """Whether a run is a digest or an identifier and so no finding."""
    m = DIGEST.fullmatch(run)
    if m and len(m[1]) in DIGEST_LENGTHS or UUID.fullmatch(run):
        return True
    return all(NAMED.fullmatch(p) for p in PARTS.findall(run)) and all(efficient(w, path, max_ratio) for w in LETTERS.findall(run))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the pattern kinds, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def random_spans(text: str, base: list[tuple[int, int, int]], path: str, max_ratio: float) -> list[tuple[int, int, int]]:
    """Runs that overlap no span of base (ordered by start) and that the vocabulary finds random; both lists are walked once."""
    out, k, reach = [], 0, 0
    for m in RUN.finditer(text):
        run = m[0]
        while k < len(base) and base[k][0] < m.end():
            reach = max(reach, base[k][2])
            k += 1
        if reach > m.start() or not LETTERS.search(run):
            continue
        if len(run) <= max_ratio * size_in_tokens(run, path) and not known(run, path, max_ratio):
            out.append((m.start(), 3, m.end()))
    return out


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(text: str, path: str, max_ratio: float = 2.2) -> tuple[list, list]:
    """Base spans and all spans of a text."""
    base = base_spans(text)
    return base, sorted(base + random_spans(text, base, path, max_ratio))


def scan(docs: DataFrame, path: str, max_ratio: float = 2.2) -> DataFrame:
    """SCHEMA rows of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                base, spans = find(text or "", path, max_ratio)
                n = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
                out.append((doc, *n[:3], hashlib.sha256(shown(base).encode()).hexdigest(), shown(spans), n[3]))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            cols = zip(*out, strict=True) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def redact_text(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """text with each union of overlapping spans replaced by mark."""
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, path: str, max_ratio: float = 2.2, mark: str = "[SECRET]") -> DataFrame:
    """docs with found spans replaced by mark in text; n_chars, where present, follows the new text.

    Overlapping spans become one mark; a null text stays null; all rows and columns are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            new = [None if t is None else redact_text(t, find(t, path, max_ratio)[1], mark) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, "text", pa.array(new, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)
    return out


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.documents(spark, sf_dir), tokens.vocabulary("byte_bpe_50k.tiktoken"))
