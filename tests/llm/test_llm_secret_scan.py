import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from wellspark.llm import secret_scan
from wellspark.llm.secret_scan import KINDS, find_secrets, scan

WORD = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"


def brute_base(text):
    """The three patterns character by character, without regular expressions."""
    out = []
    lower = "".join(c.lower() if c.isascii() else c for c in text)

    def run(i, allowed):
        j = i
        while j < len(text) and text[j] in allowed:
            j += 1
        return j

    i = 0
    while i < len(text):
        name = next((w for w in ("password", "passwd", "secret", "token", "api_key", "apikey") if lower.startswith(w, i)), None)
        j = i + len(name) if name else None
        if name and text[j:j + 1] in ('"', "'") and text[j:j + 1]:
            j += 1
        if name:
            j = run(j, " ")
        if name and text[j:j + 1] and text[j] in ":=":
            j = run(j + 1, " ")
            if text[j:j + 1] and text[j] in "\"'":
                j += 1
            end = run(j, WORD)
            if end > j:
                if end - j >= 8:
                    out.append((i, 0, end))
                i = end
                continue
        i += 1
    for kind, head, allowed, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), (2, "", "0123456789abcdef", 32)):
        i = 0
        while i < len(text):
            end = run(i + len(head), allowed) if text.startswith(head, i) else i
            if end > i + len(head):
                if end - i >= least:
                    out.append((i, kind, end))
                i = end
            else:
                i += 1
    return sorted(out)


def base_of(text):
    return [(s, k, e) for s, k, e, path, _ in scan(text)[0] if not path]


def test_base_against_brute_force():
    rng = random.Random(8)
    parts = ["password", "PassWd", "secret", "ſecret", "toKen", "toKen", "api_key", "APIKEY", "AKIA", "AKIAABCDEFGHIJ12", "=", ":", " ", "  ",
             '"', "'", "abcdefgh", "short", "0123456789abcdef" * 2, "deadbeef", "é", "日本", "\n", "%", "x", "A", "9"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(6000)]
    for text in texts:
        assert base_of(text) == brute_base(text), text
    assert sum(len(brute_base(t)) for t in texts) > 1000


# Each returns the encoded text; what is encoded is ASCII.
WRAPS = {
    "percent": lambda s: "".join(f"%{ord(c):02X}" for c in s),
    "some percent": lambda s: re.sub(r"[=:\"' ]", lambda m: f"%{ord(m[0]):02x}", s),
    "unicode": lambda s: "".join(rf"\u{ord(c):04x}" for c in s),
    "braces": lambda s: "".join(rf"\u{{{ord(c):x}}}" for c in s),
    "doubled": lambda s: "".join(rf"\\\u{ord(c):04X}" for c in s),
    "long": lambda s: "".join(rf"\U{ord(c):08x}" for c in s),
    "hex": lambda s: "".join(rf"\x{ord(c):02x}" for c in s),
    "reference": lambda s: "".join(f"&#{ord(c)};" if i % 2 else f"&#x{ord(c):x};" for i, c in enumerate(s)),
    "base64": lambda s: base64.b64encode(s.encode()).decode(),
    "url base64": lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    "mime": lambda s: base64.encodebytes((s + " " + "and so on" * 12).encode()).decode().strip(),
    "gzip": lambda s: base64.b64encode(gzip.compress(s.encode(), mtime=0)).decode(),
    "zlib": lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
    "bzip2": lambda s: base64.b64encode(bz2.compress(s.encode())).decode(),
    "xz": lambda s: base64.b64encode(lzma.compress(s.encode())).decode(),
    "zstd": lambda s: base64.b64encode(zstandard.compress(s.encode())).decode(),
    "percent gzip": lambda s: "".join(f"%{b:02x}" for b in gzip.compress(s.encode(), mtime=0)),
}
SECRETS = [("assign", "password=hunter2hunter2"), ("access", "AKIA" + "Q7" * 8), ("hex", "0f" * 20), ("assign", "Api_Key: 'abc/def+123'")]


def values(text):
    return {(KINDS[k], x) for _, k, _, _, x in scan(text)[0]}


@pytest.mark.parametrize("name", list(WRAPS))
def test_one_layer(name):
    for kind, secret in SECRETS:
        inner = WRAPS[name](f"see {secret} there")
        before, after = "日本 — über\n(see ", ") and so on\nmore é"
        hits = [(s, e) for s, k, e, _, x in scan(before + inner + after)[0] if KINDS[k] == kind and x == secret.rstrip("'")]
        assert hits and all(len(before) <= s < e <= len(before) + len(inner) for s, e in hits)


def test_nested_layers():
    rng = random.Random(11)
    for _ in range(150):
        names = rng.choices([w for w in WRAPS if w != "some percent"], k=rng.randint(2, 3))
        kind, secret = rng.choice(SECRETS)
        text = f"; {secret};"
        for name in names:
            text = WRAPS[name](text)
        assert (kind, secret.rstrip("'")) in values(f"é {text}\nend"), names
    deep = "secret: " + "k" * 12
    for _ in range(12):
        deep = WRAPS["base64"](deep)
    assert ("assign", "secret: " + "k" * 12) in values(deep)


def test_spans_are_exact():
    text = "é a%3D1 pass%77ord%3Dhunter22, %74oken=\\u0061bcdefgh"
    assert [(text[s:e], x) for s, k, e, _, x in scan(text)[0]] == [
        ("pass%77ord%3Dhunter22", "password=hunter22"), ("%74oken=\\u0061bcdefgh", "token=abcdefgh")]
    inner = "0123456789 token=abcdefgh 01234"
    coded = base64.b64encode(inner.encode()).decode()
    (start, _, end, path, secret), = scan(f"日本 {coded}")[0]
    first, last = inner.index("token"), inner.index("token") + len("token=abcdefgh")
    assert (start, end, path, secret) == (3 + 8 * first // 6, 3 + (8 * last - 1) // 6 + 1, "base64", "token=abcdefgh")
    assert scan("%2525252541KIA" + "Q7" * 8)[0][0][:3] == (0, 1, 14 + 16)


def test_base_stays_whatever_is_added():
    rng = random.Random(2)
    for _ in range(300):
        text = " ".join(rng.choice([rng.choice(list(WRAPS.values()))(s), s, "%", "\\u00", "é", "plain words"]) for _, s in rng.choices(SECRETS, k=3))
        assert base_of(text) == brute_base(text)


def test_clean_texts_stay_clean():
    for text in ("100% of \\users\\x and C:\\temp\\u12", "internationalisation/of/counterrevolutionaries 2^x x^2", "%zz %4", "&#; &#x; &#99999999;", "BZh9 x^ \x1f\x8b\x08"):
        assert scan(text) == ([], 0)


def test_what_unpacks_to_itself_ends(monkeypatch):
    """A stream that holds itself and a secret: each is entered once."""
    me = b"\x1f\x8b\x08 password=hunter22 \x1f\x8b\x08"
    monkeypatch.setattr(secret_scan, "_inflate", lambda data, most: (me, len(data)))
    found, unread = scan(base64.b64encode(me).decode())
    assert {x for *_, x in found} == {"password=hunter22"} and unread == 0


def test_a_bomb_is_counted_and_the_rest_read():
    bomb = base64.b64encode(gzip.compress(b"x" * 3_000_000 + b" password=hunter22")).decode()
    found, unread = scan(f"{bomb} token=abcdefgh", max_unpacked=1_000_000)
    assert [x for *_, x in found] == ["token=abcdefgh"] and unread == 1
    assert values(bomb) == {("assign", "password=hunter22")}


def test_very_long_text():
    text = "words of é and %41 base " * 200_000 + WRAPS["percent"]("password=hunter22" * 2000) + " " + WRAPS["gzip"](" token=abcdefgh ")
    found, _ = scan(text)
    assert {"token=abcdefgh"} < {x for *_, x in found}


def test_rows(spark, rows):
    secret = "x password=hunter22 " + WRAPS["gzip"]("token=abcdefgh")
    data = [(1, secret, "a"), (1, secret, "a"), (None, None, "b"), (2, "", None), (3, "AKIA" + "A" * 12, "c")]
    docs = spark.createDataFrame(data, "doc_id long, text string, found string")
    out = find_secrets(docs).select("doc_id", secret_scan.spans("found").alias("spans"), F.size(secret_scan.in_text(F.col("found"), "assign")).alias("n"),
                                    secret_scan.spans(secret_scan.in_text(F.col("found"))).alias("base"))
    packed = f"assign:20:{len(secret.rstrip(chr(61)))}"
    assert rows(out) == sorted([(1, f"assign:2:19,{packed}", 1, "assign:2:19")] * 2 + [(None, "", 0, ""), (2, "", 0, ""), (3, "access:0:16", 0, "access:0:16")], key=repr)
    assert find_secrets(docs.limit(0)).count() == 0


def test_query(spark, rows, tmp_path):
    from wellspark.llm.queries import QUERIES

    data = [(i, t) for i, t in enumerate(["a secret=abcdefgh " + "0f" * 16, None, WRAPS["base64"]("token: abcdefgh")])]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(QUERIES["op12_secret_scan"](spark, str(tmp_path)))
    digest = [hashlib.sha256(s.encode()).hexdigest() for s in ("assign:2:17,hex:18:50", "")]
    assert got == [(0, 1, 0, 1, digest[0], "assign:2:17,hex:18:50"), (1, 0, 0, 0, digest[1], ""), (2, 0, 0, 0, digest[1], "assign:0:20")]
