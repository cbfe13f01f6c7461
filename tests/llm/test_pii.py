import hashlib
import math
import random
import re
from collections import defaultdict

import helpers
from recordsmith.llm import pii
from recordsmith.llm.pii import base_spans, forms, luhn, op12_pii_sanitise, sanitise, units

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]


def _plain(text):
    """The contract's patterns as they are written."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    r = random.Random(1)
    parts = ["@", ".", "a", "b.c", "%", "-", "+", " ", "1", "25", "256", "0001", "9" * 15, "4111 1111 1111 1111", "(", ")", "é", "\n", "x@y.z", "+1 (", "٣"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 25)))
        assert base_spans(text) == _plain(text), text
    assert base_spans("a@b@c.de f@g.h@i.jk") == _plain("a@b@c.de f@g.h@i.jk")
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert base_spans("1" * 20_000 + " " + "a" * 50_000 + "@" + "+1 " * 10_000) == []


def test_query_base_equals_patterns_and_adds_behind(spark):
    got = op12_pii_sanitise(spark, SF)
    assert got.columns == COLUMNS
    want = {r["doc_id"]: _plain(r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        spans = want[r["doc_id"]]
        base = ",".join(f"{k}:{a}:{z}" for k, a, z in spans)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert r["spans"].startswith(base) and (base or not r["spans"])


def _corpus():
    r = random.Random(2)
    common = ["the", "meeting", "report", "office", "number", "sends", "please", "answer", "monday", "letter", "paper", "today"]
    lines = lambda n: "\n".join(" ".join(r.sample(common, 6)) for _ in range(n))
    docs = [(k, lines(6)) for k in range(60)]
    for k in range(60, 64):                                  # a name that stands with one address only
        docs.append((k, f"{lines(2)}\n{' '.join(r.sample(common, 3))} Zebulon ask zeb@mail.example {' '.join(r.sample(common, 2))} no {k}\n{lines(1)}"))
    docs += [(70, "office Zebulon once more"), (71, "zebra zebulite zebrano other zebu")]      # 70 has no address
    docs += [(80 + k, "single Hapaxword with one@mail.example " + lines(1).split("\n")[0]) for k in range(2)]
    docs[-1] = (81, docs[-2][1])                             # a copy is no evidence
    docs += [(90 + k, f"caller Quimby rang +1 202 555 0100 {r.choice(common)} {k} quimper quim{k}x") for k in range(3)]
    docs += [(200 + k, f"quimple quimlet quimsy {k}\nquimbag {k}\nquimrod {k}") for k in range(20)]
    return docs + [(100, None), (101, ""), (None, "call Zebulon at zeb@mail.example now")]


def _brute(docs, threshold):
    """Terms of every document, from plain counts over all units."""
    with_form, beside, alone, evident, total = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set), 0
    seen = defaultdict(list)
    for at, (_, text) in enumerate(docs):
        spans = _plain(text or "")
        for words in units(text or ""):
            total += 1
            every = {f for m in words for f in forms(m.group())}
            for f in every:
                with_form[f] += 1
            free = {f for m in words if not any(a < m.end() and z > m.start() for _, a, z in spans) for f in forms(m.group())}
            unit = text[words[0].start():words[-1].end()]
            for e in {pii.entity(k, text[a:z]) for k, a, z in spans if words[0].start() <= a < words[-1].end()}:
                alone[e] += 1
                seen[at].extend((e, f) for f in free)
                for f in free:
                    beside[e, f] += 1
                    evident[e, f].add((unit, text))

    def told(e, f):
        if len({u for u, _ in evident[e, f]}) < 2 or len({t for _, t in evident[e, f]}) < 2:
            return None
        return math.log2(beside[e, f] * total / (alone[e] * with_form[f])) / math.log2(total / alone[e])

    out = {}
    for at, pairs in seen.items():
        for e, f in pairs:
            if not f.endswith("*") and (d := told(e, f)) is not None and d >= threshold:
                wider = pii.general(f)
                g = told(e, wider) if wider else None
                out.setdefault(at, {})[f] = wider if g is not None and g < threshold else None
    return out


def test_terms_equal_plain_counts(spark):
    docs = _corpus()
    got = sanitise(spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, spans string").coalesce(1))
    want = _brute(docs, pii.THRESHOLD)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert len(rows) == len(docs)
    found = {}
    for at, (i, text) in enumerate(docs):
        terms = [s.split(":") for s in rows[i]["spans"].split(",") if s.split(":")[0] in ("general", "removed")]
        own = {text[int(a):int(z)].lower(): kind for kind, a, z in terms}
        if own:
            found[at] = own
    assert found == {at: {f: "general" if w else "removed" for f, w in t.items()} for at, t in want.items()}
    assert "Zebulon" not in rows[60]["sanitised"] and "[EMAIL]" in rows[60]["sanitised"]
    assert rows[70]["sanitised"] == "office Zebulon once more" and rows[70]["spans"] == ""
    assert "Hapaxword" in rows[80]["sanitised"]
    assert "quim*" in rows[90]["sanitised"] and "[PHONE]" in rows[90]["sanitised"]
    assert rows[100]["sanitised"] == rows[101]["sanitised"] == "" and "Zebulon" not in rows[None]["sanitised"]


def test_odd_rows(spark):
    df = helpers.frame(spark)
    out = sanitise(df).collect()
    assert len(out) == len(helpers.rows()) and all(r["spans"] == "" for r in out)
    texts = sorted((t or "") for _, t, *_ in helpers.rows())
    assert sorted(r["sanitised"] for r in out) == texts
    assert sanitise(df.limit(0)).count() == 0
    hot = spark.createDataFrame([(k, "same hot line me@all.example") for k in range(300)], "doc_id long, text string")
    assert {r["spans"] for r in sanitise(hot, keep_texts=False).collect()} == {"email:14:28"}
