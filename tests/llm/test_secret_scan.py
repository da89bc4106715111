"""Secret scans (4): base spans by a literal reading of the patterns, and structures."""

import base64
import hashlib
import json
import re
import struct
import time

from retailstar.llm import secret_scan as S


def der(tag, body):
    n = len(body)
    head = bytes([n]) if n < 128 else bytes([0x80 + (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + head + body


INT = der(2, b"\x01" * 20)
PKCS1 = der(0x30, der(2, b"\0") + INT * 8)
PKCS8 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x86\x48") + der(5, b"")) + der(4, PKCS1))
STR = lambda b: struct.pack(">I", len(b)) + b
OPENSSH = b"openssh-key-v1\0" + STR(b"none") * 2 + STR(b"") + struct.pack(">I", 1) + STR(b"p" * 30) + STR(b"k" * 64)


def b64url(x):
    return base64.urlsafe_b64encode(x).rstrip(b"=").decode()


TOKEN = f"{b64url(json.dumps({'alg': 'HS256', 'typ': 'JWT'}).encode())}.{b64url(json.dumps({'sub': 1}).encode())}.{b64url(b's' * 32)}"


def kinds(text):
    return [k for _, _, k in S.structural_spans(text)]


def test_structures_are_confirmed():
    assert kinds("x " + base64.b64encode(PKCS1).decode() + " y") == ["key"]
    assert kinds(base64.b64encode(PKCS8).decode()) == ["key"]
    assert kinds(PKCS1.hex()) == ["key"]
    assert kinds(base64.b64encode(OPENSSH).decode()) == ["key"]
    body = base64.b64encode(PKCS8).decode()
    armour = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(body[i:i + 64] for i in range(0, len(body), 64)) + "\n-----END PRIVATE KEY-----"
    assert "armour" in kinds(armour)
    assert kinds("auth " + TOKEN) == ["signed"]


def test_lookalikes_are_left_alone():
    assert kinds(base64.b64encode(PKCS1[:-3]).decode()) == []       # lengths don't fit
    assert kinds(base64.b64encode(PKCS1 + b"\0").decode()) == []
    assert kinds(base64.b64encode(bytes(range(200))).decode()) == []
    assert kinds("abc.def.ghi " + "a" * 20 + "." + "b" * 20 + "." + "c" * 20) == []
    assert kinds(base64.b64encode(OPENSSH[:-1]).decode()) == []
    assert kinds("-----BEGIN PRIVATE KEY-----\nAAAA\n-----END PRIVATE KEY-----") == []


ENCRYPTED = der(0x30, der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x05\x0d") + der(0x30, der(4, b"s" * 8) + der(2, b"\x08\0")))
                + der(4, bytes(range(256))))


def wrap(s, n, eol="\n"):
    return eol.join(s[i:i + n] for i in range(0, len(s), n))


def test_keys_wrapped_over_lines():
    for data in (PKCS1, PKCS8, OPENSSH, ENCRYPTED):
        for n in (64, 76):
            for body in (base64.b64encode(data).decode(), data.hex()):
                for eol in ("\n", "\r\n  "):
                    w = wrap(body, n, eol)
                    assert S.structural_spans(f"see: {w}\nend of it\n") == [(5, 5 + len(w), "key")]
                    assert S.masked(f"see: {w}\nend", "*") == "see: *\nend"
    assert kinds(wrap(base64.b64encode(PKCS1[:-3]).decode(), 64)) == []


def test_keys_inside_long_blocks_of_lines():
    noise = base64.b64encode(bytes(range(48))).decode()
    for data in (PKCS8, OPENSSH, ENCRYPTED):
        w = wrap(base64.b64encode(data).decode(), 64)
        text = f"{noise}\n{noise}\n{w}\n\n{noise}\n{w}"
        assert [text[a:b] for a, b, _ in S.structural_spans(text)] == [w, w]
    # an end inside a line is none
    body = base64.b64encode(PKCS1 + b"\0" * 3).decode()
    assert kinds(wrap(body, 64)) == []


def test_time_is_linear_in_the_text():
    line = base64.b64encode(b"\x30\x83\x01\x00\x00\x02\x01\x00" + b"\x05" * 40).decode()
    start = base64.b64encode(OPENSSH[:48]).decode()
    nested = "-----BEGIN PRIVATE KEY-----\na: "
    for text in ((line + "\n") * 16_000, start + ("\n" + "A" * 64) * 16_000, (start + "\n") * 16_000, nested * 16_000,
                 "M" + "A" * 1_000_000, ("token" + " " * 50) * 20_000):
        took = time.process_time()
        assert S.structural_spans(text) == [] and len(S.base_spans(text)) >= 0
        assert time.process_time() - took < 5, text[:40]


def test_encrypted_keys():
    assert kinds(base64.b64encode(ENCRYPTED).decode()) == ["key"]
    digest = der(0x30, der(0x30, der(6, b"\x60\x86\x48\x01\x65") + der(5, b"")) + der(4, b"h" * 32))
    assert kinds(base64.b64encode(digest).decode()) == []
    body = wrap(base64.b64encode(ENCRYPTED).decode(), 64)
    assert "armour" in kinds(f"-----BEGIN ENCRYPTED PRIVATE KEY-----\n{body}\n-----END ENCRYPTED PRIVATE KEY-----")


def test_armour_with_header_lines():
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n"
    for n, found in ((64, ["armour"]), (61, [])):
        body = wrap(base64.b64encode(bytes(range(100, 100 + n))).decode(), 64)
        assert kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{head}{body}\n-----END RSA PRIVATE KEY-----") == found
    body = wrap(base64.b64encode(PKCS1).decode(), 64)
    assert "armour" in kinds(f"-----BEGIN RSA PRIVATE KEY-----\nComment: mine\n\n{body}\n-----END RSA PRIVATE KEY-----")


def brute(t):
    t = t or ""
    pats = [("assign", r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
             r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
            ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24)]
    spans = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p, ok) in enumerate(pats)
             for m in re.finditer(p, t) if ok(m)]
    n = [sum(x[1] == i for x in spans) for i in range(3)]
    return (*n, hashlib.sha256(",".join(x[2] for x in sorted(spans)).encode()).hexdigest())


EDGE = [None, "", "é token= \"abcdef\" Password:xyz api_key='ABC-_./=' APIKEY==a", "TOKEN=short toKen = longenough",
        "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 11, "0" * 23 + " " + "a" * 24, "toKen=abcdefgh paſſword=abcdefgh",
        "secret=" + "f" * 40 + "secret=" + TOKEN, "😀 passwd: '" + PKCS1.hex() + "'", "tokentoken=abcdef token:" + " " * 50 + "=zzzzzz"]


def test_rows(spark):
    rows = [(i, t) for i, t in enumerate(EDGE)] + [(2, EDGE[2]), (None, "token=123456")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_hex int").repartition(2)
    got = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in S.scan_documents(df, ["doc_id"]).collect()]
    assert sorted(got, key=str) == sorted([(i, *brute(t)) for i, t in rows], key=str)
    assert S.scan_documents(df.limit(0), ["doc_id"]).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = S.query(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == brute(texts[r.doc_id])
        assert r.n_assign + r.n_access + r.n_hex <= len([x for x in r.spans.split(",") if x])


def test_redaction_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a token=abcdefgh b", 18, "k"), (2, None, None, "k"), (3, "clean", 5, "k")],
                               "doc_id long, text string, n_chars long, masked string")
    out = S.redact_documents(df)
    assert out.dtypes == df.dtypes
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [
        (1, "a [secret] b", 12, "k"), (2, None, None, "k"), (3, "clean", 5, "k")]
