import hashlib
import random
import re
from collections import Counter
from math import log2

import pyarrow as pa

from farelight.llm import secret_scan


def base_spans(text):
    text = text or ""
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    spans = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))


ODD = [
    None, "", 'PASSWORD: "abcdefgh" token=1234567 token=12345678 secret : abcdefg', "é" * 9 + " " + "0123abcd" * 4 + "g " + "f" * 31 + " Token='deadbeefdeadbeef'",
    "AKIAABCDEFGHIJKL AKIA1 AKIAAKIAAKIAAKIA1é", "secrettoken=abcdefgh ſecret=abcdefghi api_key=a.b-c/d+e=f_ apikey: x", "toKen=abcdefgh1🚕token=abcdefgh2",
    "passwd = 'password = abcdefghi'", "ab" * 40, "0" * 40,
]


def test_known_kinds():
    for (row, spans), text in zip(secret_scan.scan(pa.array(ODD)), ODD, strict=True):
        assert [s for s in spans if s[0] != "entropy"] == base_spans(text), row


def test_entropy_of_windows_is_that_of_the_definition():
    random.seed(2)
    for _ in range(1500):
        alphabet = random.choice(["0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCXYZ0123456789", "ab1", "abcdefghijklmnopqrstuvwxyz"])
        text = "".join(random.choices(alphabet, k=random.randint(15, 60)))
        kind, found = secret_scan.character_class(text), secret_scan.entropy_span(text)
        if kind is None or any(a in text.lower() for a in secret_scan.ALLOWED):
            assert found is None
            continue
        high = []
        for i in range(len(text) - secret_scan.WINDOW + 1):
            counts = Counter(text[i : i + secret_scan.WINDOW])
            own = secret_scan.character_class(text[i : i + secret_scan.WINDOW])
            least = min(secret_scan.THRESHOLDS[kind], secret_scan.THRESHOLDS[own if own in ("hex", "digits") else kind])
            if -sum(n / secret_scan.WINDOW * log2(n / secret_scan.WINDOW) for n in counts.values()) >= least - 1e-9:
                high.append(i)
        assert found == ((high[0], high[-1] + secret_scan.WINDOW) if high else None)


def entropy(text):
    return [s[1:] for s in next(secret_scan.scan(pa.array([text])))[1] if s[0] == "entropy"]


def test_entropy_adds_and_the_allow_list_suppresses():
    assert entropy("é key A1b2C3d4E5f6G7h8I9j0KLMN.") == [(6, 30)]
    assert entropy("EXAMPLEA1b2C3d4E5f6G7h8I9j0KLMN") == [] == entropy("thererehandingeratestionwhich andoredhestheringaneris")
    # What a known kind has found is not repeated.
    assert entropy("token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff") == []


def test_an_allowed_part_hides_only_what_it_touches():
    key = "A1b2C3d4E5f6G7h8I9j0KLMN"
    for before in ("/sample/pk_live_", "SAMPLE_KEY=ghp_", "your_", "a====", "EXAMPLE/"):
        (found,) = entropy(before + key)
        assert found[0] <= len(before) and found[1] == len(before + key), before
    assert entropy(key + "/example")[0][0] == 0
    # Beside a harmless word in the same piece there is no span; farther away there is.
    assert entropy("sample" + key) == [] == entropy(key + "dummy")
    assert entropy("sample" + key + "q8W7e6R5t4Y3u2I1o0P9") == [(26, 50)]
    # Long runs hold short parts by chance: only the windows over them are lost.
    random.seed(5)
    run = "".join(random.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvw0123456789", k=4000))
    assert entropy(run) == [(0, 4000)]
    assert entropy(run[:1000] + "xXxx" + run[1000:2000] + "////" + run[2000:]) == [(0, 1000), (1004, 2004), (2008, 4008)]


def test_a_glued_name_does_not_change_the_class():
    random.seed(6)
    for alphabet in ("0123456789ABCDEF", "0123456789abcdef"):
        for _ in range(200):
            key = "".join(random.choices(alphabet, k=24))
            if secret_scan.character_class(key) != "hex" or secret_scan.blocked_windows(key):
                continue
            alone = secret_scan.entropy_span(key)
            for before in ("id=", "Key_", "/v/"):
                (found,) = secret_scan.entropy_spans(before + key) or [None]
                assert alone is None or found[0] <= alone[0] + len(before) and found[1] >= alone[1] + len(before)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    found = secret_scan.scan_secrets(odd_docs).collect()
    assert len(found) == len(odd_rows)
    assert {tuple(r)[1:] for r in found if r["doc_id"] in (1, 2, 3)} == {(0, 0, 0, hashlib.sha256(b"").hexdigest(), "")}
    assert secret_scan.scan_secrets(no_docs).count() == 0


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in secret_scan.op7_secret_scan(spark, sf_dir).collect():
        spans = base_spans(texts[r["doc_id"]])
        joined = ",".join(":".join(map(str, s)) for s in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in secret_scan.KINDS[:3]] == [sum(s[0] == k for s in spans) for k in secret_scan.KINDS[:3]]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_recall_by_class():
    """Share of random strings found, alone and behind a name; the README has these figures."""
    random.seed(9)
    lower = "abcdefghijklmnopqrstuvwxyz"
    for alphabet, length, least in (
        (lower, 32, 0.93), (lower, 64, 0.98), (lower.upper(), 40, 0.95), ("0123456789", 32, 0.97), ("0123456789", 40, 0.98),
        ("0123456789abcdef", 32, 0.97), (lower + lower.upper() + "0123456789", 32, 0.99),
    ):
        for before in ("", "id="):
            keys = ["".join(random.choices(alphabet, k=length)) for _ in range(500)]
            assert sum(bool(secret_scan.entropy_spans(before + k)) for k in keys) >= least * len(keys), (alphabet, length, before)


def test_words_and_numbers_that_are_no_secrets():
    for text in (
        "the-quick-brown-fox-jumps-over-the-lazy-dog", "internationalization_of_configuration",
        "2024-01-31_12-59-07_0001", "00000000000000000000000001", "1111222233334444555566667777", "/usr/share/local/documents/plain",
    ):
        assert secret_scan.entropy_spans(text) == [], text


def test_few_false_hits_in_prose(spark):
    """No run of letters of the corpus is taken for a secret."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").toArrow().column(0)
    for row, spans in secret_scan.scan(rows):
        text = rows[row].as_py() or ""
        assert not any(kind == "entropy" and text[a:b].isalpha() for kind, a, b in spans)
