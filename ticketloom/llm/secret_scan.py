"""Secrets in texts: pattern matches, and encoded values confirmed by their structure.

Three patterns report what they match. Beside them, runs of base64 or hex are decoded and
reported only if the bytes parse whole: DER private keys, whose nested lengths must fill
each other exactly, OpenSSH key files with their length-prefixed fields, JSON keys, and
armoured keys inside a further layer of encoding. Signed tokens are reported if their
header and claims decode to JSON objects that name an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.storage import map_batches

#: The pattern kinds in their order, then the confirmed ones.
KINDS = ("assign", "access", "hex", "armoured", "token", "key")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
# Runs that are too short fail as a whole, so the least length can stand in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_BEGIN = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*){2,4}")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}(?:\r?\n[A-Za-z0-9+/_-]+)*={0,2}")
_HEX_BYTES = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
# All of these but the first two hold such a run: the body of armour, the signature of
# a token or the head of an encrypted one are that long.
_LONG_RUN = b"x" * 24
_RUN_BYTES = bytes(0x78 if re.fullmatch(r"[A-Za-z0-9+/_-]", chr(c)) else 0x20 for c in range(256))
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Layers of encoding that are taken off one after another.
LAYERS = 3

# Object identifiers in DER, without tag and length.
_RSA = bytes.fromhex("2a864886f70d010101")
_EC = bytes.fromhex("2a8648ce3d0201")
_EDWARDS = (bytes.fromhex("2b6570"), bytes.fromhex("2b6571"), bytes.fromhex("2b656e"), bytes.fromhex("2b656f"))
_PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
_PKCS7 = bytes.fromhex("2a864886f70d0107")
_INTEGER, _BITS, _OCTETS, _OID, _SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30
_OPENSSH = b"openssh-key-v1\0"
#: Bytes; no key in use has numbers of over 32,768 bits.
_LONGEST_NUMBER = 4097
#: Signature algorithms and the bytes of their signatures; 0 where the key decides.
_SIGNED = {
    "HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 0,
    "RS256": 0, "RS384": 0, "RS512": 0, "PS256": 0, "PS384": 0, "PS512": 0,
}


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, findings): for every whole text of `docs` (doc_id long, text) its secrets as
    structs (kind, start, end, proof) in code points, end exclusive, ordered by start, then
    by KINDS. `proof` says what was confirmed; it never repeats the secret.

    `assign`, `access` and `hex` are all leftmost non-overlapping matches of their patterns,
    each kind by itself. Confirmed spans may overlap them and each other's kinds.

    A null text is empty and has no findings. Rows that repeat an id, or have none, are
    scanned each by itself; extra columns are not read; an empty table gives no rows.
    """
    kind = "array<struct<kind:string,start:int,end:int,proof:string>>"
    scanned = map_batches(
        docs, ["doc_id", "text"], "doc_id bigint, kinds array<string>, starts array<int>, ends array<int>, proofs array<string>", lambda: _scan_texts
    )
    findings = F.expr("transform(arrays_zip(kinds, starts, ends, proofs), f -> "
                      "named_struct('kind', f.kinds, 'start', f.starts, 'end', f.ends, 'proof', f.proofs))")  # fmt: skip
    return scanned.select("doc_id", findings.cast(kind).alias("findings"))


def joined(findings, kinds=KINDS):
    """Findings of some kinds as text: kind:start:end, parted by commas."""
    some = F.filter(findings, lambda f: f["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def _scan_texts(doc_ids: list, texts: list) -> dict[str, list]:
    found = [find_secrets(text or "") for text in texts]
    columns = [[list(column) for column in zip(*some)] if some else [[], [], [], []] for some in found]
    kinds, starts, ends, proofs = ([one[nth] for one in columns] for nth in range(4))
    return {"doc_id": doc_ids, "kinds": kinds, "starts": starts, "ends": ends, "proofs": proofs}


def find_secrets(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, proof) in order."""
    found = [("access", *m.span(), "access key id") for m in _ACCESS.finditer(text)]
    lower = text.lower()
    # What a pattern needs to be there at all is looked for first: that is much faster.
    if any(name in lower for name in _NAMES):
        found += [("assign", *m.span(), "named value") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if _LONG_RUN in text.encode().translate(_RUN_BYTES):
        found += [("hex", *m.span(), "hexadecimal run") for m in _HEX.finditer(text)]
        found += _confirmed(text, LAYERS)
    return sorted(found, key=lambda one: (one[1], KINDS.index(one[0]), one[2]))


def _confirmed(text: str, layers: int) -> Iterator[tuple[str, int, int, str]]:
    """What proves to be a key or a token once it is decoded."""
    taken = [0]  # ends of armoured keys, so that their bodies are not reported again

    for start, end, proof in _armoured(text):
        taken += [start, end]
        yield "armoured", start, end, proof
    for m in _TOKEN.finditer(text):
        if proof := _signed_token(m[0]):
            yield "token", *m.span(), proof
    inside = iter(zip(taken[1::2], taken[2::2]))
    begin, stop = next(inside, (len(text), len(text)))
    for start, end, proof in _encoded(text, layers):
        while start >= stop and begin < len(text):
            begin, stop = next(inside, (len(text), len(text)))
        if start < begin:
            yield "key", start, end, proof


def _encoded(text: str, layers: int) -> list[tuple[int, int, str]]:
    found = []
    for m in _BASE64.finditer(text):
        if hit := _base64_key(m[0], layers):
            found.append((m.start(), m.start() + hit[0], hit[1]))
    for m in _HEX_BYTES.finditer(text):
        if proof := _key_proof(bytes.fromhex(m[0]), layers):
            found.append((*m.span(), f"hex {proof}"))
    return sorted(found)


def _base64_key(run: str, layers: int) -> tuple[int, str] | None:
    """(characters, proof) of the key that a base64 run begins with. The first line alone
    counts, and all lines together; a DER value also says itself where it ends."""
    first = re.match(r"[^\r\n]*", run)[0]
    for part in dict.fromkeys((first, run)):
        data = _from_base64(part)
        if data is not None and (proof := _key_proof(data, layers)):
            return len(part), f"base64 {proof}"
    head = _from_base64(first[:16]) or b""
    if head[:1] == b"\x30" and (size := _der_size(head)):
        chars, seen = -(-size * 4 // 3), 0
        for at, char in enumerate(run):
            seen += char not in "\r\n="
            if seen == chars:
                data = _from_base64(run[: at + 1])
                proof = data and _key_proof(data, 0)
                padding = re.match("={0,2}", run[at + 1 :])[0]
                return (at + 1 + len(padding), f"base64 {proof}") if proof else None
    return None


def _from_base64(text: str) -> bytes | None:
    plain = re.sub(r"[\r\n=]", "", text).replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _key_proof(data: bytes, layers: int) -> str | None:
    """What key some bytes are, from first to last; None if they are none."""
    if data[:1] == b"\x30":
        return _der_key(data)
    if data.startswith(_OPENSSH):
        return _openssh_key(data)
    if layers:
        try:
            text = data.decode("utf-8")
        except UnicodeDecodeError:
            return None
        if proof := _json_key(text):
            return proof
        for _, _, _, proof in _confirmed(text, layers - 1):
            return f"of {proof}"
    return None


# -- armour and tokens ----------------------------------------------------------------


def _armoured(text: str) -> Iterator[tuple[int, int, str]]:
    at = 0
    while begin := _BEGIN.search(text, at):
        close, at = f"-----END {begin[1]}-----", begin.end()
        end = text.find("-----", begin.end())
        if end < 0 or not text.startswith(close, end):
            continue
        # Keys in source code have their line feeds spelled out.
        body = text[begin.end() : end].replace("\\r", "").replace("\\n", "\n")
        if proof := _armour_proof(begin[1], [line.strip() for line in body.split("\n")]):
            at = end + len(close)
            yield begin.start(), at, proof


def _armour_proof(label: str, lines: list[str]) -> str | None:
    headers = [line for line in lines if ":" in line]
    body = [line for line in lines if ":" not in line and line]
    if label.endswith("BLOCK"):  # an OpenPGP packet; its checksum line begins with =
        data = _from_base64("".join(line for line in body if not line.startswith("=")))
        tag = data and data[0]
        secret = tag and (tag & 0xC0 == 0xC0 and tag & 0x3F == 5 or tag & 0xC0 == 0x80 and tag >> 2 & 0xF == 5)
        return "OpenPGP secret key" if secret else None
    data = _from_base64("".join(body))
    if not data:
        return None
    if any(line.startswith("DEK-Info:") for line in headers):
        return "encrypted armoured key" if len(data) % 8 == 0 else None
    proof = _openssh_key(data) if data.startswith(_OPENSSH) else _der_key(data)
    return proof and f"armoured {proof}"


def _signed_token(text: str) -> str | None:
    header, claims, *rest = text.split(".")
    head = _json_object(header)
    if not head or not isinstance(head.get("alg"), str):
        return None
    if len(rest) == 3:  # encrypted: header, key, vector, text, tag
        whole = all(_from_base64(part) for part in (rest[0], rest[1], rest[2]))
        return f"encrypted token {head['alg']}" if isinstance(head.get("enc"), str) and whole else None
    if len(rest) != 1 or head["alg"] not in _SIGNED:
        return None
    signature, size = _from_base64(rest[0]), _SIGNED[head["alg"]]
    signed = signature and (len(signature) == size if size else len(signature) >= 64)
    return f"signed token {head['alg']}" if signed and _json_object(claims) is not None else None


def _json_object(part: str) -> dict | None:
    data = _from_base64(part)
    try:
        value = json.loads(data.decode("utf-8")) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _json_key(text: str) -> str | None:
    if not text.lstrip().startswith("{"):
        return None
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return None
    if not isinstance(value, dict):
        return None
    secret = {"oct": "k"}.get(str(value.get("kty")), "d")
    if value.get("kty") in ("RSA", "EC", "OKP", "oct") and isinstance(value.get(secret), str):
        return f"JSON web key {value['kty']}" if _from_base64(value[secret]) else None
    if isinstance(value.get("private_key"), str):
        for _, _, proof in _armoured(value["private_key"]):
            return f"JSON with {proof}"
    return None


# -- key encodings --------------------------------------------------------------------


def _der_size(data: bytes) -> int | None:
    """Bytes of the DER value that begins here, header included."""
    if len(data) < 2:
        return None
    if data[1] < 0x80:
        return 2 + data[1]
    n = data[1] & 0x7F
    if not 1 <= n <= 4 or len(data) < 2 + n or not data[2]:
        return None
    size = int.from_bytes(data[2 : 2 + n], "big")
    return 2 + n + size if size >= 0x80 else None  # a shorter form would have to be used


def _der_values(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of values that stand end to end; None unless they fill the bytes."""
    out = []
    while data:
        size = _der_size(data)
        if size is None or size > len(data):
            return None
        head = 2 if data[1] < 0x80 else 2 + (data[1] & 0x7F)
        out.append((data[0], data[head:size]))
        data = data[size:]
    return out


def _der_key(data: bytes) -> str | None:
    """The kind of private key that some bytes hold, from first to last."""
    whole = _der_values(data)
    if not whole or len(whole) != 1 or whole[0][0] != _SEQUENCE:
        return None
    values = _der_values(whole[0][1]) or []
    tags = [tag for tag, _ in values]
    if any(tag == _INTEGER and len(content) > _LONGEST_NUMBER for tag, content in values):
        return None
    first = values[0][1] if values else b""
    if tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS] and first in (b"\0", b"\1"):
        return _pkcs8(values)
    if tags[:9] == [_INTEGER] * 9 and first in (b"\0", b"\1"):
        n, e, *_ = (int.from_bytes(content, "big") for _, content in values[1:])
        p, q = (int.from_bytes(content, "big") for _, content in values[4:6])
        return "RSA private key" if n > e > 1 and (first == b"\1" or p * q == n) else None
    if tags == [_INTEGER] * 6 and first == b"\0":
        p, q, g = (int.from_bytes(content, "big") for _, content in values[1:4])
        return "DSA private key" if p > g > 1 and q > 1 and (p - 1) % q == 0 else None
    if tags[:2] == [_INTEGER, _OCTETS] and first == b"\1" and set(tags[2:]) <= {0xA0, 0xA1}:
        return "EC private key" if 16 <= len(values[1][1]) <= 72 else None
    if tags == [_SEQUENCE, _OCTETS]:
        scheme = _der_values(first) or [(0, b"")]
        known = scheme[0][0] == _OID and scheme[0][1].startswith(_PASSWORD_BASED)
        return "encrypted private key" if known and values[1][1] else None
    if tags[:2] == [_INTEGER, _SEQUENCE] and first == b"\3":
        content = _der_values(values[1][1]) or [(0, b"")]
        return "key store" if content[0][0] == _OID and content[0][1].startswith(_PKCS7) else None
    return None


def _pkcs8(values: list[tuple[int, bytes]]) -> str | None:
    algorithm, inner = _der_values(values[1][1]), values[2][1]
    if not algorithm or algorithm[0][0] != _OID or not {tag for tag, _ in values[3:]} <= {0xA0, 0x81, 0xA1}:
        return None
    oid = algorithm[0][1]
    if oid == _RSA:
        return "RSA private key" if _der_key(inner) == "RSA private key" else None
    if oid == _EC:
        return "EC private key" if _der_key(inner) == "EC private key" else None
    seed = _der_values(inner)
    if oid in _EDWARDS:
        return "Edwards private key" if seed and seed[0][0] == _OCTETS and len(seed[0][1]) in (32, 56, 57) else None
    return "private key" if seed and len(seed) == 1 else None


def _openssh_key(data: bytes) -> str | None:
    """Cipher, derivation, its options, a number, as many public keys, the private part:
    all but the number with their length before them, and nothing behind."""
    rest = data[len(_OPENSSH) :]

    def field() -> bytes:
        nonlocal rest
        size = int.from_bytes(rest[:4], "big")
        if len(rest) < 4 + size:
            raise ValueError
        value, rest = rest[4 : 4 + size], rest[4 + size :]
        return value

    try:
        cipher, _, _ = field(), field(), field()
        number, rest = int.from_bytes(rest[:4], "big"), rest[4:]
        if not 1 <= number <= 16:
            return None
        for _ in range(number):
            field()
        private = field()
    except ValueError:
        return None
    # Without encryption the private part begins with the same four bytes twice.
    whole = cipher != b"none" or private[:4] == private[4:8]
    return "OpenSSH private key" if cipher and len(private) >= 8 and whole and not rest else None
