"""Secret scans: fixed patterns plus dictionary-primed compression novelty.

The patterns find the usual shapes.  The method then measures every other
token-like string that stands near a sensitive word, on either side: how many bytes does it add
to one zstandard stream that holds common identifiers and the text around it?  Names
and repeated values are copied from what the stream knows and cost 3 to 6 bits per character; random keys must be
spelled out and cost 6.5 and more, and are reported.  No rule on digits, letters or dots decides.

Limits: strings under ``min_length`` characters cost whole bytes too coarse to judge, and random strings of
lower-case letters alone (4.7 bits each) cost as little as unknown words; neither is reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")   # also the order of kinds at one start

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")   # whole runs of [0-9a-f] that are long enough

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+")     # dots part tokens, so the parts of a dotted token are measured one by one
SENSITIVE = re.compile(r"passw|passphrase|secret|token|credential|api.?key|access.?key|private.?key|bearer"
                       r"|authoriz|\bauth\b|\bpwd\b|signing.?key|client.?id", re.IGNORECASE | re.ASCII)

# Identifier dictionary: words that code and configuration repeat everywhere.
IDENTIFIERS = """
abstract account address alias android application argument array assert async attribute author await backup base
boolean bootstrap boundary branch break browser bucket buffer build button byte cache callback case catch channel char
class client cluster column command commit component config configuration connection console const constructor
container content context continue controller cookie copy count create credentials current cursor database date
debug default delete deploy description development device directory document domain double download driver element
email enable encoding endpoint engine environment error event example exception execute export extends extension
false field file filter final finally float folder font format from function generate getter global group handler
hash header height host html http https identifier image implements import index init input instance integer interface
internal invoice item iterator java javascript json key label language layout length level library line list listener
local localhost location logger login long main manager message metadata method migration mobile model module mount
name namespace network node null number object offset option order output override package page parameter parent
password path pattern payload percent permission pipeline platform plugin pointer policy port position prefix private
process production profile project property protected protocol provider proxy public python query queue random read
record redirect refresh region register release remote remove render replace report repository request resource
response result return role root route runtime schema scope script search secret select selector sequence server
service session setting shared signature size socket source stack standard start state static status storage stream
string struct style subject submit suffix super switch symbol system table target task template test text thread
throw timeout timestamp title token trace transaction true type unique unit update upload user username utility
value variable version view virtual void volume widget width window worker workspace write yaml
0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ
"""


@dataclass(frozen=True)
class NoveltyRules:
    context: int = 2048          # code points of surrounding text in the stream, each side
    near: int = 128              # code points between a string and a sensitive word, at most, on either side
    min_length: int = 10         # characters of a string that is measured
    min_bits: float = 6.25       # marginal compressed bits per character
    level: int = 3


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the pattern matches, leftmost and non-overlapping per kind."""
    out = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 6:
            out.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                out.append((m.start(), 1, m.end()))
    for m in LONG_HEX.finditer(text):
        out.append((m.start(), 2, m.end()))
    return out


def marginal_bits(candidate: str, before: str, after: str, rules: NoveltyRules) -> float:
    """Compressed bits per character that ``candidate`` adds to a stream of the identifiers and the text around it."""
    zc = zstandard.ZstdCompressor(level=rules.level, write_content_size=False, write_checksum=False, write_dict_id=False)
    known = (IDENTIFIERS + after + "\n" + before).encode("utf-8", "replace")
    added = len(zc.compress(known + candidate.encode())) - len(zc.compress(known))
    return 8.0 * added / len(candidate)


def sensitive_ranges(text: str, near: int) -> list[list[int]]:
    """Disjoint ranges of the text that lie within ``near`` code points of a sensitive word."""
    out: list[list[int]] = []
    for word in SENSITIVE.finditer(text):
        lo, hi = max(0, word.start() - near), word.end() + near
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return out


def novel_spans(text: str, taken: list[tuple[int, int, int]], rules: NoveltyRules) -> list[tuple[int, int, int]]:
    """Spans of incompressible strings that reach into the surroundings of a sensitive word, outside the spans in ``taken``."""
    out, done = [], 0
    for lo, hi in sensitive_ranges(text, rules.near):
        while lo > done and TOKEN.match(text, lo - 1, lo):
            lo -= 1                                          # a token that begins before the range is measured whole
        for m in TOKEN.finditer(text, max(lo, done)):
            s, e = m.span()
            if s > hi:
                break
            done = e
            if e - s < rules.min_length or any(s < b and a < e for a, _, b in taken):
                continue
            before, after = text[max(0, s - rules.context):s], text[e:e + rules.context]
            if marginal_bits(m.group(), before, after, rules) >= rules.min_bits:
                out.append((s, 3, e))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


SCAN_TYPE = "struct<n_assign:bigint,n_access:bigint,n_hex:bigint,n_novel:bigint,base_spans:string,spans:string>"


def scan_text(text: str | None, rules: NoveltyRules) -> dict:
    text = text or ""
    base = base_spans(text)
    novel = novel_spans(text, base, rules)
    return {"n_assign": sum(k == 0 for _, k, _ in base), "n_access": sum(k == 1 for _, k, _ in base),
            "n_hex": sum(k == 2 for _, k, _ in base), "n_novel": len(novel),
            "base_spans": joined(base), "spans": joined(base + novel)}


def secret_spans(docs: DataFrame, rules: NoveltyRules = NoveltyRules(),
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, counts per kind, pattern spans and all spans.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then
    kind.  A null text is empty and has no spans; null ids and repeated rows are
    scanned like any row.
    """
    kind = pa.struct([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                      ("n_novel", pa.int64()), ("base_spans", pa.string()), ("spans", pa.string())])

    @F.arrow_udf(SCAN_TYPE)
    def scan(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            yield pa.array([scan_text(t.as_py(), rules) for t in array], kind)

    return (docs.select(F.col(id_col).alias("doc_id"), scan(F.col(text_col)).alias("s"))
            .select("doc_id", "s.*"))


def secret_digest(found: DataFrame) -> DataFrame:
    """The digest columns of a result of :func:`secret_spans`."""
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans", "n_novel")

