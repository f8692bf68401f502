"""Base spans against plain regular expressions; layers of every kind; odd rows."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

import pyarrow as pa
import pytest
import zstandard

from qalake.llm import queries
from qalake.llm.secret_scan import _suspects, redact_text, scan, scan_text

from .data import DOC_SCHEMA, documents, odd_documents, words

SECRET = 'token = "ab12cd34ef56"'


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


def brute(text):
    """The contract's patterns, one match after the other."""
    out = []
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    keys = "|".join(map(either, ("password", "passwd", "secret", "token"))) + "|" + either("api") + "_?" + either("key")
    for m in re.finditer(f"({keys})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m.group(2)) >= 8:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return [(k, a, e) for a, _, e, k in sorted(out)]


def mixed_texts(n=400, seed=2):
    rng = random.Random(seed)
    bits = ["password", "PassWD", "secret", "token", "api_key", "apikey", "ſecret", "toKen", "=", ":", " ", "  ", '"', "'", "abcdefgh",
            "abc", "A+/_.=-9", "AKIA", "AKIAABCDEFGH1234", "AKIAabc", "0123456789abcdef" * 2, "deadbeef" * 3, "é", "\n", "x", "AKIAAKIA"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def base_only(text):
    return [(k, a, e) for k, a, e, how in scan_text(text) if not how]


def test_base_spans_and_digest(spark, tmp_path):
    texts = mixed_texts() + [None, ""]
    rows = [(i, t, "en", "s", 0, 1.0, 7, "z") for i, t in enumerate(texts)] + odd_documents()[-3:]
    for t in texts:
        assert base_only(t or "") == brute(t or "")
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_secret_scan(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < len(texts):
            want = brute(texts[r["doc_id"]] or "")
            text = ",".join(f"{k}:{a}:{e}" for k, a, e in want)
            assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
            assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x[0] for x in want) for k in ("assign", "access", "hex"))
            assert set(want) <= {(k, int(a), int(e)) for k, a, e in (x.split(":") for x in r["spans"].split(",") if x)}


PACKED = [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.ZstdCompressor().compress]
QUOTED = urllib.parse.quote(SECRET, safe="")


@pytest.mark.parametrize("inner", [
    QUOTED, urllib.parse.quote(urllib.parse.quote(QUOTED)), "".join(f"\\u{ord(c):04x}" for c in SECRET),
    "".join(f"\\\\\\x{ord(c):02X}" for c in SECRET), "".join(f"&#{ord(c)};" for c in SECRET), "".join(f"%u{ord(c):04X}" for c in SECRET),
    urllib.parse.quote("".join(f"\\u{ord(c):04x}" for c in SECRET)), b64(SECRET), b64(SECRET).rstrip("="),
    b64(b64(b64(SECRET))), b64(QUOTED), b64(SECRET.encode("utf-16-le")),
    base64.urlsafe_b64encode(("??>>~~" + SECRET).encode()).decode(), *(b64(f(SECRET.encode())) for f in PACKED),
    *(b64(f(f(b64(f(("y" * 3_000_000 + SECRET).encode())).encode()))) for f in PACKED),
    *(urllib.parse.quote(f(SECRET.encode()), safe="") for f in PACKED[:1]),
])
def test_a_secret_below_layers_is_reported_where_it_stands(inner):
    text = f"Ünless é {inner} and more"
    assert not brute(text)
    assert 0 in _suspects(pa.array([text]))
    spans = scan_text(text)
    kind, a, e, how = spans[0]
    assert kind == "assign" and how
    assert text.index(inner) <= a < e <= text.index(inner) + len(inner)
    assert "and more" in redact_text(text, spans) and inner not in redact_text(text, spans)


def test_places_are_exact_where_characters_are_kept():
    text = f"a%20b é {QUOTED} c"
    (_, a, e, how), = scan_text(text)
    assert how == "escape" and urllib.parse.unquote(text[a:e]) == SECRET[:-1]
    inside = b64("x" * 30 + SECRET + "y" * 30)
    (_, a, e, _), = scan_text(inside)
    assert 36 <= a <= 42 and e < len(inside) - 30


def test_mail_lines_and_paths():
    body = base64.encodebytes(("z" * 50 + SECRET + "q " * 40).encode()).decode()
    for text in (f"Begin\n{body}\nEnd", f"key/{b64(SECRET)}"):
        assert 0 in _suspects(pa.array([text])) and [s[0] for s in scan_text(text)] == ["assign"]


def test_layers_extend_base_spans_and_repeat_none():
    text = "token=abcdefgh%2Bmore%2Bletters and token=abcdefgh%20x"
    got = scan_text(text)
    assert [s[3] for s in got] == ["", "escape", ""]
    assert text[got[1][1]:got[1][2]] == "token=abcdefgh%2Bmore%2Bletters"
    twice = f"{b64(SECRET)} {b64(SECRET)}"
    assert len(scan_text(twice)) == 2


def test_self_unpacking_data_and_damage_end():
    from qalake.llm.secret_scan import _inflated
    # stored blocks around a copy: data whose unpacked head is its own head
    data = gzip.compress(b"x" * 10)
    depth, pieces = _inflated(data)
    assert depth == 1 and b"".join(pieces) == b"x" * 10
    cut = gzip.compress((SECRET + " " + words(random.Random(1), 500)).encode())[:300]
    assert scan_text("x " + b64(cut))[0][0] == "assign"
    for junk in (b"\x1f\x8b\x08junk", b"BZh9junk", b"\xfd7zXZ\0junk", b"\x28\xb5\x2f\xfdjunk", b"x\x9cjunk"):
        assert scan_text(b64(junk + b"\xff" * 20)) == []
    assert scan_text("\\" * 30_000 + "%25" * 30_000) == []


def test_rows_that_are_passed_over_hold_nothing():
    rng = random.Random(5)
    texts = [words(rng, 40) for _ in range(150)] + mixed_texts(150, 9) + [b64(words(rng, 9)) for _ in range(50)]
    some = set(_suspects(pa.array(texts + [None, ""])).tolist())
    assert all(i in some or not scan_text(t) for i, t in enumerate(texts))
    assert len(some) < 250


def test_odd_rows(spark):
    got = scan(documents(spark)).collect()
    assert len(got) == len(odd_documents()) and all(r["spans"] == [] for r in got)
    assert scan(documents(spark, [])).count() == 0
    assert scan(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()["spans"] == []
    assert DOC_SCHEMA.startswith("doc_id")
