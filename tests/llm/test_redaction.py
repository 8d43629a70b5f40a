import re

from wardwise.llm import secrets

BODY = "\n".join("MIIEow" + "Ab9/" * 14 + "+x" for _ in range(30))
BEGIN, END = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
TEXTS = {
    1: f"key:\n{BEGIN}\n{BODY}\nQUJD\n{END}\nafter - text",
    2: f"{BEGIN}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123\n\n{BODY}\n{END} after",
    3: f"cut off {BEGIN}\n{BODY}\nQUJDRA==\n",
    4: f"{BEGIN}\\n{'Ab9/' * 16}\\nQUJDRA==\\n{END}\" after",
    5: "a header " + BEGIN + " in prose, no key",
    6: "token=eyJabcdefgh1.eyJabcdefgh2.sig/moreSecretBytes==.tail end",
    7: "password=hunt3r_ghp_" + "a" * 36 + "/s3cretTail99 end",
    8: "\U0001f600 é " + "AKIA0123456789ABCD x " * 700 + "tail",
    9: "clean", 10: None, 11: "",
}
WANT = {1: "key:\n<SECRET>\nafter - text", 2: "<SECRET> after", 3: "cut off <SECRET>\n", 4: "<SECRET>\" after",
        5: "a header <SECRET> in prose, no key", 6: "<SECRET> end", 7: "<SECRET> end",
        8: "\U0001f600 é " + "<SECRET> x " * 700 + "tail", 9: "clean", 10: None, 11: ""}


def test_whole_secrets_go(docs):
    out = {r.doc_id: r.text for r in secrets.redact(docs(list(TEXTS.items()))).collect()}
    assert out == WANT


def test_pem_span_covers_the_key(docs):
    pem = next(i for i, r in enumerate(secrets.RULES) if r.kind == "pem")
    rows = secrets.scan(docs([(i, TEXTS[i]) for i in (1, 3)])).collect()
    for r in rows:
        span = next(s for s in r.spans if s["rank"] == pem)
        assert BODY in r.text[span.start:span.end]


def test_union_of_spans_against_brute_force(docs, documents):
    table = documents.limit(300)
    spans = {r.doc_id: r.spans for r in secrets.scan(table).collect()}
    for r, raw in zip(*(sorted(x.collect(), key=lambda r: r.doc_id) for x in (secrets.redact(table), table))):
        held, at, text = [], 0, raw.text or ""
        hit = bytearray(len(text))
        for s in spans[r.doc_id]:
            hit[s.start:s.end] = b"\1" * (s.end - s.start)
        for m in re.finditer(b"\1+", bytes(hit)):
            held += [text[at:m.start()], "<SECRET>"]
            at = m.end()
        assert (r.text or "") == "".join(held) + text[at:]
