"""Secret scan: base patterns and dictionary-primed compression novelty (operator 5)."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from roadlens.llm.common import map_batches, process_cache

#: The base patterns, and the length that a match must have.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "novel")

#: Words that make a nearby string sensitive.
CONTEXT = re.compile(r"pass(?:word|wd|phrase|code)?\b|secret|token|api[_-]?key|credential|bearer|authorization|"
                     r"private[_ -]?key|access[_ -]?key|\bauth\b|\bpwd\b|signature|client[_-]?id", re.IGNORECASE | re.ASCII)
#: A candidate: an unbroken run of key characters.
SHORTEST = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
#: What may stand between the lines or parts of one key, and the short last
#: line of a key block.
GAP = re.compile(r"""[\s.:\\"',>|]{1,48}""")
LAST_LINE = re.compile(r"""(?:\\[nr]|[\s\\"',>|]){1,48}([A-Za-z0-9+/_=]{1,15})(?:\\[nr]|[\s\\"',>|]){1,48}-----END""")
#: Characters before or behind a candidate in which a context word must stand,
#: and the surrounding characters on each side that prime the compressor.
NEAR, AROUND = 48, 256
#: Marginal compressed bytes per character from which a string is incompressible
#: (random keys cost 0.8 to 1.0; names made of words that the dictionary knows 0.2 to 0.6).
NOVEL_AT = 0.7
#: The same for a candidate next to a found one (lines of random base64 amid
#: others cost 0.65 to 0.75); the short last line of a found block needs none.
NEXT_AT = 0.6
#: Identifiers of everyday code; they prime the compressor, so they cost little.
IDENTIFIERS = (
    "access_key_id", "access_token", "api_key_name", "application_default_credentials", "auth_token_provider",
    "authorization_code", "authorization_header", "AuthorizationServerConfiguration", "aws_access_key_id",
    "aws_secret_access_key", "aws_session_token", "bearer_token_auth", "BasicAuthenticationFilter", "client_id",
    "client_secret", "config.get", "ConfigurationProperties", "const token = process.env", "credential_provider",
    "createAccessToken", "csrf_token_field", "DATABASE_PASSWORD", "DB_PASSWORD", "default_password_hasher",
    "encrypted_password", "environment_variable", "example_password_123", "export SECRET_KEY_BASE", "forgot_password_link",
    "generate_password_hash", "get_access_token", "getElementById", "github_token", "hash_password_sha256",
    "insert_your_key_here", "InvalidPasswordException", "jwt_token_expires_in", "localhost:8080", "login_required",
    "max_token_length_512", "os.environ.get", "password_confirmation", "password_reset_token", "passwordEncoder",
    "placeholder_value_0000", "private_key_id", "public_key_base64", "refresh_token", "replace_with_your_token",
    "requests.post(url, headers=headers)", "response.json()", "secret_key_base", "secretKeyRef", "secrets.token_hex(32)",
    "self.assertEqual", "session_token_name", "settings.SECRET_KEY", "signature_version_4", "TOKEN_EXPIRATION_SECONDS_3600",
    "token_type_ids", "username_or_email", "utf-8", "UUID.randomUUID().toString()", "verify_password", "x-api-key",
    "xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx", "your_api_key_here", "00000000000000000000000000000000", "0123456789abcdef",
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "1234567890",
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost and non-overlapping per kind."""
    out = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    return out


class Novelty:
    """Marginal compressed size of a string behind its surroundings."""

    def __init__(self, identifiers):
        import zstandard

        words = zstandard.ZstdCompressionDict("\n".join(identifiers).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.size = lambda b: len(self.zip.compress(b))
        self.zip = zstandard.ZstdCompressor(level=6, dict_data=words, write_content_size=False, write_checksum=False)

    def per_char(self, text: str, start: int, end: int, parts: list[tuple[int, int]] | None = None) -> float:
        """Bytes that ``text[start:end]``, or only its ``parts``, adds to the
        compressed surroundings, per character."""
        around = (text[max(0, start - AROUND):start] + "\n" + text[end:end + AROUND] + "\n").encode()
        more = "".join(text[s:e] for s, e in parts or [(start, end)])
        return (self.size(around + more.encode()) - self.size(around)) / len(more)


def _chains(text: str) -> Iterator[list[tuple[int, int]]]:
    """The candidates, those that follow each other as lines or parts of one
    key together; the last line of a key block may be short."""
    chain: list[tuple[int, int]] = []
    for m in CANDIDATE.finditer(text):
        if chain and not GAP.fullmatch(text, chain[-1][1], m.start()):
            yield chain
            chain = []
        chain.append(m.span())
        last = LAST_LINE.match(text, m.end())
        if last:
            chain.append(last.span(1))
    if chain:
        yield chain


def _outside(s: int, e: int, held: list[list], at: int) -> list[tuple[int, int]]:
    """The parts of a candidate that lie outside the base spans, from the
    ``at``-th on; what stands before an assignment is its name and no part."""
    parts = []
    while at < len(held) and held[at][0] < e:
        if s < held[at][0] and not held[at][2]:
            parts.append((s, held[at][0]))
        s = max(s, held[at][1])
        at += 1
    return parts + [(s, e)] if s < e else parts


def novel_spans(text: str, taken: list[tuple[int, int, str]], novelty: Novelty) -> list[tuple[int, int, str]]:
    """Incompressible candidates, outside the base spans, near a context word
    or next to a candidate that is (the lines of a key block, the parts of a
    web token)."""
    words = [m.span() for m in CONTEXT.finditer(text)]
    if not words:
        return []
    starts = [s for s, _ in words]
    held: list[list] = []  # the base spans as disjoint stretches, in order, and whether they begin with an assignment
    for s, e, kind in sorted(taken):
        if held and s <= held[-1][1]:
            held[-1][1] = max(held[-1][1], e)
        else:
            held.append([s, e, kind == "assign"])

    def near(s: int, e: int) -> bool:
        i = bisect_left(starts, s - NEAR)
        return i < len(words) and words[i][1] <= e + NEAR

    out, at = [], 0
    for chain in _chains(text):
        if not any(near(s, e) for s, e in chain):
            continue
        pieces = []  # the parts of each candidate, what they cost, and from where on they are part of a found key
        for s, e in chain:
            while at < len(held) and held[at][1] <= s:
                at += 1
            parts = _outside(s, e, held, at)
            cost = novelty.per_char(text, s, e, parts) if parts else NOVEL_AT
            pieces.append((parts, cost, NEXT_AT if e - s >= SHORTEST else 0))
        found = [cost >= NOVEL_AT for _, cost, _ in pieces]
        for order in (range(1, len(pieces)), range(len(pieces) - 2, -1, -1)):
            step = order.step
            for i in order:
                found[i] = found[i] or found[i - step] and pieces[i][1] >= pieces[i][2]
        out += [(a, b, "novel") for (parts, _, _), yes in zip(pieces, found) if yes for a, b in parts]
    return out


def find_spans(text: str, novelty: Novelty) -> list[tuple[int, int, str]]:
    base = base_spans(text)
    spans = base + novel_spans(text, base, novelty)
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2])))


def _digest(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _novelty() -> Novelty:
    return process_cache(("novelty", IDENTIFIERS), lambda: Novelty(IDENTIFIERS))


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, spans)`` with ``spans`` an array
    of ``(start, end, kind)`` in code points, by start and then kind
    (``assign``, ``access``, ``hex``, ``novel``).  A null text is empty;
    null and repeated ids and repeated rows are kept row by row; other
    columns are ignored; an empty table gives an empty result.  Nothing is
    shuffled."""

    def run(batch: pa.RecordBatch):
        found = [find_spans(t or "", _novelty()) for t in batch.column(1).to_pylist()]
        return batch.column(0), [[{"start": s, "end": e, "kind": k} for s, e, k in x] for x in found]

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, run, f"doc_id {kind}, spans array<struct<start:int,end:int,kind:string>>")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts and digests of ``scan_secrets``: ``(doc_id, n_assign, n_access,
    n_hex, n_novel, base_sha256, spans)``."""
    def text_of(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "novel")
    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    n = [number(k) for k in KINDS]
    return found.select("doc_id", *n, F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"))


def redact(text: Column) -> Column:
    """``text`` with every found span replaced by ``[kind]`` (overlapping spans
    become one, named after the first); null stays null, clean texts stay as
    they are."""
    def without_spans(t: str) -> str:
        parts, at = [], 0
        for s, e, k in find_spans(t, _novelty()):
            if s >= at:
                parts += [t[at:s], f"[{k}]"]
            at = max(at, e)
        return "".join([*parts, t[at:]])

    @F.pandas_udf("string")
    def cleaned(col: pd.Series) -> pd.Series:
        return pd.Series([without_spans(t) if isinstance(t, str) else None for t in col], dtype=object)

    return cleaned(text)


def redacted_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with redacted texts and, where there is such a column, the
    length of each changed text; all other columns and all rows stay."""
    new = docs.withColumn("_redacted", redact(F.col(text)))
    changed = F.col("_redacted") != F.col(text)
    out = {text: F.col("_redacted")}
    if n_chars in docs.columns:
        out[n_chars] = F.when(changed, F.length("_redacted").cast(docs.schema[n_chars].dataType)).otherwise(F.col(n_chars))
    return new.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
