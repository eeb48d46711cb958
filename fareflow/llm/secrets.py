"""Secret scan with structural confirmation.

Three base patterns (assignments, access key ids, long hex runs) report on
their form alone.  Beside them, runs of base64 or hex characters are candidates
that report only if what they decode to is built like a key: DER private keys
whose nested lengths close exactly, OpenSSH private keys, PEM blocks around
either, and signed tokens whose header is a JSON object naming an algorithm.
A key or token may begin anywhere in a run, and a key's own lengths say where
it ends, so characters that touch it don't hide it; runs are joined over line
breaks, real ones and those written as ``\\n`` or ``\\r\\n``, and hex may have its
bytes apart by a colon, a blank or ``\\x``.

Candidate texts are found with run lengths over the bytes of a whole chunk;
patterns run only on texts that can match.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from fareflow.llm.common import text_udf

#: Order of kinds that start at the same place.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "der", "openssh", "jwt")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_BREAK = r"[ \t]*(?:\r\n?|\n|\\r\\n|\\n|\\r)[ \t]*"
_BREAKS = re.compile(_BREAK)
_NOT_HEX = re.compile(r"[^0-9A-Fa-f]+")
_LINES = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{20,}}+(?:{_BREAK}[A-Za-z0-9+/_-]++)+")
_PAIRS = re.compile(r"[0-9A-Fa-f]{2}(?:(?::|\x20|\\x|:?[ \t]*\r?\n[ \t]*)[0-9A-Fa-f]{2}){19,}")
_PAIRS_START = re.compile(r"30(?::|\x20|\\x)(?:[0-7][0-9A-Fa-f]|8[0-4])")
#: PEM blocks; header lines (Proc-Type, DEK-Info) may come first.
_PEM = re.compile(r"-----BEGIN ([A-Z ]{0,30}PRIVATE KEY)-----((?:(?:\s|\\[nr])*[A-Z][A-Za-z-]{1,30}: [^\r\n\\:]{1,200})*"
                  r"(?:[A-Za-z0-9+/=\s]|\\[nr])*)-----END \1-----")
_ENCIPHERED = re.compile(r"Proc-Type: 4,ENCRYPTED\s*(?:\\[nr])*\s*DEK-Info: [A-Z0-9-]+,[0-9A-Fa-f]+")
_PEM_BREAK = re.compile(r"\s+|\\[nr]")
_BASE64_START = re.compile(r"M[A-I]|b3BlbnNzaC1rZXktdjEA")
_HEX_RUN = re.compile(r"[0-9A-Fa-f]{40,}")
_HEX_START = re.compile(r"(?=30(?:[0-7].|8[0-4])|6f70656e7373682d6b65792d763100)", re.IGNORECASE)
_TOKEN_START = re.compile(r"e[yw]")
_JWT_TAIL = re.compile(r"\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
_MIN_RUN = 20
#: More members than a private key's sequence has; longest name of a cipher.
_MAX_MEMBERS, _CIPHER_NAME = 12, 64
_JSON = json.JSONDecoder()
_FIRST_KEY = re.compile(r'\{\s*"(?:[^"\\]|\\.)*"\s*:')
_RUN_BYTES = np.zeros(256, dtype=bool)
_RUN_BYTES[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True


def decode_base64(run: str) -> bytes | None:
    """Bytes of a base64 or base64url run, padded or not."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _der(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the value at ``at``; None if it doesn't fit."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            return None
        n, at = int.from_bytes(data[at:at + k], "big"), at + k
    return (tag, at, at + n) if at + n <= end else None


def _members(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The members of a sequence; None if they don't fill it, or are more than
    any private key has."""
    out = []
    while at < end:
        m = _der(data, at, end)
        if m is None or len(out) == _MAX_MEMBERS:
            return None
        out.append(m)
        at = m[2]
    return out


def is_der_private_key(data: bytes, at: int = 0, end: int | None = None) -> bool:
    """PKCS#1, DSA, PKCS#8 or SEC1 private key from ``at`` whose lengths close
    exactly at ``end``.  Looks at a few members, however long the data is."""
    end = len(data) if end is None else end
    top = _der(data, at, end)
    if top is None or top[0] != 0x30 or top[2] != end:
        return False
    parts = _members(data, top[1], top[2])
    if not parts or parts[0][0] != 0x02 or parts[0][2] - parts[0][1] != 1:
        return False
    tags, version = [p[0] for p in parts], data[parts[0][1]]
    if version == 0 and len(parts) in (6, 9) and set(tags) == {0x02}:  # DSA, RSA
        return True
    if version in (0, 1) and len(parts) >= 3 and tags[1:3] == [0x30, 0x04]:
        inner = _members(data, parts[1][1], parts[1][2])
        return bool(inner) and inner[0][0] == 0x06
    return version == 1 and len(parts) >= 2 and tags[1] == 0x04 and 20 <= parts[1][2] - parts[1][1] <= 72


def is_encrypted_key(data: bytes) -> bool:
    """PKCS#8 key under a password: an algorithm and the enciphered bytes."""
    top = _der(data, 0, len(data))
    parts = _members(data, top[1], top[2]) if top and top[0] == 0x30 and top[2] == len(data) else None
    if not parts or [p[0] for p in parts] != [0x30, 0x04]:
        return False
    inner = _members(data, parts[0][1], parts[0][2])
    return bool(inner) and inner[0][0] == 0x06 and parts[1][2] > parts[1][1]


def is_pem_key(label: str, body: str) -> bool:
    """The body of a PEM block holds a key of its label: a readable one, one
    under a password, or one that its header lines say is enciphered."""
    headers, _, rest = body.rpartition(":")
    if headers:
        # header lines end at the first line without a colon
        _, _, rest = rest.partition("\n") if "\n" in rest else rest.partition("\\n")
    data = decode_base64(_PEM_BREAK.sub("", rest))
    if not data:
        return False
    if headers:
        return bool(_key_kind(data)) or _ENCIPHERED.search(body) is not None and len(data) >= 32 and len(data) % 8 == 0
    return bool(_key_kind(data)) or label.startswith("ENCRYPTED ") and is_encrypted_key(data)


def is_openssh_key(data: bytes) -> bool:
    """``openssh-key-v1`` whose length-prefixed fields lie within the data."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, fields = len(magic), 0
    while fields < 3:  # cipher, kdf, kdf options
        n = int.from_bytes(data[at:at + 4], "big")
        at += 4 + n
        fields += 1
        if at + 4 > len(data):
            return False
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys + 1):  # public keys, then the private section
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at <= len(data)


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "openssh" if is_openssh_key(data) else "der" if is_der_private_key(data) else None


def is_token(header: str, payload: str) -> bool:
    """Signed-token header and payload: JSON objects, the first with ``alg``."""
    head, body = _json_object(header), _json_object(payload)
    return head is not None and isinstance(head.get("alg"), str) and body is not None


def _json_object(run: str) -> dict | None:
    try:
        found = json.loads((decode_base64(run) or b"").decode("utf-8"))
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def _token_start(run: str, payload: str) -> int | None:
    """First place from which the run is a token's header.  The run is decoded
    once for each of the four ways in which groups of four can lie; a place that
    does not begin with a JSON key, or has no ``alg`` behind it, costs nothing."""
    places = [m.start() for m in _TOKEN_START.finditer(run)]
    if not places or _json_object(payload) is None:
        return None
    texts: dict[int, str | None] = {}
    last: dict[int, int] = {}  # a header that begins behind the last "alg" has none
    for at in places:
        phase = at % 4
        if phase not in texts:
            data = decode_base64(run[phase:])
            # Latin-1 keeps one character a byte; what is found is read again as UTF-8
            texts[phase] = None if data is None else data.decode("latin-1")
            last[phase] = (texts[phase] or "").rfind('"alg"')
        text, begin = texts[phase], (at - phase) // 4 * 3
        if text is None or begin > last[phase] or not _FIRST_KEY.match(text, begin):
            continue
        try:
            found, end = _JSON.raw_decode(text, begin)
        except (ValueError, RecursionError):
            continue
        if end == len(text.rstrip(" \t\r\n")) and isinstance(found, dict) and is_token(run[at:], payload):
            return at
    return None


def find_secrets(text: str, long_run: bool = True) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind."""
    found = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if long_run:
        found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if long_run or _PAIRS_START.search(text):
        found += _confirmed(text)
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _der_size(head: bytes) -> int | None:
    """Bytes of the sequence that begins with ``head``, if an integer is first in it."""
    if len(head) < 2 or head[0] != 0x30:
        return None
    n, at = head[1], 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4:
            return None
        n, at = int.from_bytes(head[at:at + k], "big"), at + k
    return at + n if head[at:at + 1] == b"\x02" else None


def _keys(run: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the keys in a run without breaks or padding.  The
    run is decoded once for each of the four ways in which groups can lie."""
    done, decoded = 0, {}
    for m in _BASE64_START.finditer(run):
        at = m.start()
        if at < done:
            continue
        phase = at % 4
        if phase not in decoded:
            whole = run[phase:]
            decoded[phase] = decode_base64(whole[:-1] if len(whole) % 4 == 1 else whole) or b""
        data, begin = decoded[phase], (at - phase) // 4 * 3
        if run[at] == "M":
            size = _der_size(data[begin:begin + 12])
            if size is not None and begin + size <= len(data) and is_der_private_key(data, begin, begin + size):
                done = at + -(-size * 4 // 3)
                yield "der", at, done
        elif int.from_bytes(data[begin + 15:begin + 19], "big") <= _CIPHER_NAME and is_openssh_key(data[begin:]):
            done = len(run)
            yield "openssh", at, len(run)
    for h in _HEX_RUN.finditer(run):
        yield from ((k, h.start() + a, h.start() + b) for k, a, b in _hex_keys(h[0]))


def _hex_keys(run: str) -> Iterator[tuple[str, int, int]]:
    done, decoded = 0, {}
    for m in _HEX_START.finditer(run):
        at = m.start()
        if at < done:
            continue
        phase = at % 2
        if phase not in decoded:
            decoded[phase] = bytes.fromhex(run[phase:len(run) - (len(run) - phase) % 2])
        data, begin = decoded[phase], (at - phase) // 2
        if run[at] == "3":
            size = _der_size(data[begin:begin + 12])
            if size is not None and begin + size <= len(data) and is_der_private_key(data, begin, begin + size):
                done = at + 2 * size
                yield "der", at, done
        elif int.from_bytes(data[begin + 15:begin + 19], "big") <= _CIPHER_NAME and is_openssh_key(data[begin:]):
            done = at + 2 * (len(data) - begin)
            yield "openssh", at, done


def _joined_keys(text: str, m: re.Match, between: re.Pattern) -> Iterator[tuple[str, int, int]]:
    """Keys of a match without what lies ``between`` its pieces; offsets in ``text``."""
    pieces, at = [], m.start()
    for b in between.finditer(text, m.start(), m.end()):
        pieces.append((at, text[at:b.start()]))
        at = b.end()
    pieces.append((at, text[at:m.end()]))
    begins, total = [], 0
    for _, p in pieces:
        begins.append(total)
        total += len(p)

    def place(at: int) -> int:
        i = bisect.bisect_right(begins, at) - 1
        return pieces[i][0] + at - begins[i]
    for kind, a, b in _keys("".join(p for _, p in pieces)):
        yield kind, place(a), place(b - 1) + 1


def _padded(text: str, end: int) -> int:
    """``end`` behind the padding, if it follows."""
    return end + len(text[end:end + 2]) - len(text[end:end + 2].lstrip("="))


def _confirmed(text: str) -> list[tuple[str, int, int]]:
    out = []
    for m in _RUN.finditer(text):
        run, start = m[0].rstrip("="), m.start()
        if tail := _JWT_TAIL.match(text, m.end()):
            token = _token_start(run, tail[1])
            if token is not None:
                out.append(("jwt", start + token, tail.end()))
                continue
        out += [(kind, start + a, _padded(text, start + b)) for kind, a, b in _keys(run)]
    blocks = []
    if "-----BEGIN " in text:
        blocks = [("pem", *m.span()) for m in _PEM.finditer(text) if is_pem_key(m[1], m[2])]
    joined = [(kind, a, _padded(text, b)) for m in _LINES.finditer(text)
              for kind, a, b in _joined_keys(text, m, _BREAKS)]
    if _PAIRS_START.search(text):
        joined += [k for m in _PAIRS.finditer(text) for k in _joined_keys(text, m, _NOT_HEX)]
    taken = out + blocks
    out += [k for k in joined if not any(a < k[2] and k[1] < b for _, a, b in taken)]
    return out + blocks


def _has_long_run(texts: pa.Array) -> np.ndarray:
    """Texts with a run of at least 20 base64 characters (a run that crosses
    into the next text may flag it too)."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts.to_pylist()]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    flags = np.zeros(len(raw), dtype=bool)
    if not len(data):
        return flags
    edge = np.diff(np.concatenate([[0], _RUN_BYTES[data].view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= _MIN_RUN
    ends = np.cumsum([len(r) for r in raw])
    first, last = (np.searchsorted(ends, x, side="right") for x in (start[long], end[long] - 1))
    for a, b in zip(first, last):
        flags[a:b + 1] = True
    return flags


def _kernel(texts: pa.Array) -> pa.Array:
    flags = _has_long_run(texts)
    rows = [[] if not t else [{"kind": k, "start": s, "end": e}
                              for k, s, e in find_secrets(t, bool(f) or "-----BEGIN " in t)]
            for t, f in zip(texts.to_pylist(), flags)]
    return pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))


def secret_spans(text: Column) -> Column:
    """array<struct<kind, start, end>> of a text column, by start and then
    kind; offsets in code points, ends exclusive.  Null and empty texts give
    an empty array."""
    return text_udf(_kernel, "array<struct<kind:string,start:bigint,end:bigint>>")(text)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
