import random
import re

from pyspark.sql import functions as F

from msalake.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans(documents):
    rng = random.Random(8)
    bits = ["a@b.c", "a@b", "x.y%z+w@mail-1.example.com", "@", "a@b.c@d.e", "_a@b.c_d@e.f", "1.2.3.4", "256.1.1.1", "001.02.3.0004", "1.2.3.4.5.6.7.8", "999.1.1.1.1",
            "4041894974608795", "4041 8949 7460 8795", "4041-8949-7460-8796", "+1 (386) 555-3733", "+12", "+1.......", "++49 30 1234567", "\U0001f600é", " ", "\n", "-", ".",
            "12", "00000000000000", "+1(386)555-3733 4041894974608795", "0" * 30, "9" * 40 + ".1.1.1"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(400)] + [None, "", "1 " * 5000, "a" * 30000, "1" * 20000, ("a." * 9000) + "@"]
    out = pii.find(documents(*enumerate(texts)).withColumn("body", F.lit(1)).withColumn("id", F.lit(3)), support=10**9).collect()
    assert len(out) == len(texts)
    for r in out:
        assert [tuple(s) for s in r.base] == brute(texts[r.doc_id]), texts[r.doc_id][:200]
        assert r.spans == r.base


def test_disclosing_terms(documents):
    rng = random.Random(2)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, say(40)) for i in range(300)]
    rows += [(1000 + i, f"{say(10)} Kumquatson {say(2)} wordaa mailto@x.org {say(12)} kumquatson") for i in range(6)]
    copied = f"{say(10)} Onlyincopies y@copy.org {say(9)}"
    rows += [(2000 + i, copied) for i in range(20)] + [(3000, "kumquatson alone"), (None, "x mailto@x.org Kumquatson")]
    got = {r.doc_id: r for r in pii.find(documents(*rows)).select("doc_id", "body", "base", "spans", pii.written("spans").alias("w"), pii.sanitised().alias("clean")).collect()}
    for i in range(6):
        r = got[1000 + i]
        terms = [r.body[s.start:s.end] for s in r.spans if s.kind == 4]
        assert terms == ["Kumquatson", "kumquatson"] and "mailto@x.org" not in r.clean and "[EMAIL]" in r.clean and r.clean.count("[TERM]") == 2
        assert r.w.startswith("term:") and ",email:" in r.w
    assert not got[2003].spans[1:] and got[3000].spans == [] and got[3000].clean == "kumquatson alone"
    assert [s.kind for s in got[pii.LAST_ID].spans] == [0, 4]


def test_empty(documents):
    assert pii.find(documents((1, "a")).limit(0)).count() == 0
