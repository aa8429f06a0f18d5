"""Secret scans that link the parts of a credential.

Base spans are reported by themselves: assignments to names of secrets,
access identifiers and long hexadecimal strings. The method adds weak parts,
none of which means much alone: an *ident* (user name or client id), a *blob*
(a random-looking string) and an *endpoint* (a URL or host). Parts are
intervals; a weak part is reported only if a complementary part stands in the
same scope, a paragraph (text between blank lines), however far from it:

* an ident needs a secret (blob, assignment or hex);
* a blob needs an ident, an access identifier or an endpoint;
* an endpoint needs a secret and an identifier both.

The intervals of a text come sorted by place, so the interval join is one
sweep: for each kind the last part before and the next part after a place are
the only ones that can be nearest. It is linear in the parts and makes no
pairs, and a text never leaves the task that read it.

Defined results: a null text is empty and has no spans; an empty table gives
an empty result; repeated rows are scanned each. Spans are counted in code
points, end exclusive, and sorted by start, then kind, then end.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame

from millrace.llm.texts import map_texts

REACH = float("inf")  # code points to a partner: any number inside the scope
# Kinds in the order in which they are listed.
KINDS = ("assign", "access", "hex", "ident", "blob", "endpoint")

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

IDENT = re.compile(
    r"""\b(?:user(?:_?name)?|login|account|client_?id|access_?key_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{3,}""",
    re.IGNORECASE | re.ASCII,
)
IDENT_NAMES = ("user", "login", "account", "client", "key")
ENDPOINT = re.compile(
    r"""(?:[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]+|\b(?:endpoint|host|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:-]{4,})""",
    re.IGNORECASE | re.ASCII,
)
ENDPOINT_NAMES = ("://", "endpoint", "host", "server")
BLOB = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_-])", re.ASCII)
SCOPE = re.compile(r"\n[\x20\t\r]*\n")

SECRETS, IDENTS = ("assign", "hex", "blob"), ("access", "ident")
NEEDS = {"ident": (SECRETS,), "blob": ((*IDENTS, "endpoint"),), "endpoint": (SECRETS, IDENTS)}

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    low = text.lower()
    found: list[Span] = []
    if any(name in low for name in NAMES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def random_looking(part: str) -> bool:
    """Digits, capitals and small letters, and no character in a third of its places."""
    return (
        any(c.isdigit() for c in part) and any(c.isupper() for c in part) and any(c.islower() for c in part)
        and max(map(part.count, set(part))) * 3 < len(part)
    )


def weak_parts(text: str) -> list[Span]:
    low = text.lower()
    found: list[Span] = []
    if any(name in low for name in IDENT_NAMES):
        found += [("ident", *m.span()) for m in IDENT.finditer(text)]
    if any(name in low for name in ENDPOINT_NAMES):
        found += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    return found + [("blob", *m.span()) for m in BLOB.finditer(text) if random_looking(m[0])]


def linked(text: str, base: list[Span], weak: list[Span], reach: float = REACH) -> list[Span]:
    """The weak parts that have what they need in their scope, at most ``reach`` code points away."""
    if not weak:
        return []
    covered = sorted((b, e) for _, b, e in base)
    starts = [b for b, _ in covered]

    def inside_base(begin: int, end: int) -> bool:
        at = bisect_right(starts, begin) - 1
        return at >= 0 and covered[at][1] > begin or at + 1 < len(covered) and covered[at + 1][0] < end

    weak = [w for w in weak if w[0] != "blob" or not inside_base(w[1], w[2])]
    gaps = [m.span() for m in SCOPE.finditer(text)]
    breaks = [b for b, _ in gaps]
    begins: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    ends: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    for kind, begin, end in (*base, *weak):
        begins[kind].append((begin, end))
        ends[kind].append((end, begin))
    for kind in KINDS:
        begins[kind].sort()
        ends[kind].sort()

    def near(kinds: tuple[str, ...], begin: int, end: int) -> bool:
        low = max(begin - reach, gaps[at - 1][1] if (at := bisect_right(breaks, begin)) else 0)
        high = min(end + reach, breaks[at] if (at := bisect_left(breaks, end)) < len(breaks) else len(text))
        for kind in kinds:
            # the last that ends by ``begin``, and the first that begins from ``end`` on
            before = bisect_right(ends[kind], (begin, begin)) - 1
            after = bisect_left(begins[kind], (end, end))
            if before >= 0 and ends[kind][before][0] >= low or after < len(begins[kind]) and begins[kind][after][0] <= high:
                return True
            # one that overlaps, other than the part itself
            first = bisect_right(begins[kind], (begin, end)) - 1
            for b, e in begins[kind][max(0, first - 1) : first + 3]:
                if (b, e) != (begin, end) and b < end and e > begin:
                    return True
        return False

    return [w for w in weak if all(near(kinds, w[1], w[2]) for kinds in NEEDS[w[0]])]


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, each sorted by start, kind and end."""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = base_spans(text)
    return sorted(base, key=order), sorted({*base, *linked(text, base, weak_parts(text))}, key=order)


def listed(spans: list[Span]) -> str:
    return ",".join([f"{kind}:{begin}:{end}" for kind, begin, end in spans])


def scan_texts(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, counts of base spans, base_sha256, and all spans of each whole text."""

    def rows(texts: list[str]) -> dict[str, list]:
        out: dict[str, list] = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
        for t in texts:
            base, spans = scan(t)
            for kind in KINDS[:3]:
                out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
            out["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
            out["spans"].append(listed(spans))
        return out

    return map_texts(docs, keys, text, rows, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
