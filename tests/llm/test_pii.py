import re

import pytest

from shelfsight.llm.pii import find_personal_data, listed, redact


def spans(documents, *texts):
    rows = find_personal_data(documents(list(texts))).select("doc_id", listed("pii").alias("s"))
    return [r.s for r in sorted(rows.collect())]


@pytest.mark.parametrize(
    "text, want",
    [
        ("mail a.b@c.de now", "email:5:13"),
        ("a@b.cx_y@d.e", "email:0:6,email:6:12"),
        ("é 1.2.3.4 and 1.2.3.256", "ip:2:9"),
        ("1.2.3.4.5.6.7.8", "ip:0:7,ip:8:15"),
        ("pay 4111 1111-1111 1111.", "card:4:23"),
        ("pay 4111 1111-1111 1112.", ""),
        ("call +49 (30) 1234567", "phone:5:21"),
        ("+12", ""),
        ("+4(9)3(0)1(2)3(4)5", "phone:0:18"),
        ("+1 (2)  3  (4)  5  (6)  7 (8) (9)", "phone:0:32"),
        ("tel +4--9--3--0--1--2--3--4--5", "phone:4:30"),
        ("1.2.3.4", "ip:0:7"),
        ("4 1 1 1-1 1 1 1 1 1 1 1 1 1 1 1", "card:0:31"),
        ("IBAN DE89370400440532013000 ok", "iban:5:27"),
        ("IBAN DE89370400440532013001 ok", ""),
        ("tel 030 1234567", "local_phone:4:15"),
        ("see 030 1234567", ""),
    ],
)
def test_spans(documents, text, want):
    assert spans(documents, text) == [want]


def test_base_kinds_are_their_plain_patterns(documents, made):
    text = "x@y.z, 10.0.0.1; 4111111111111111 / +1 (555) 010-9999 " + made(50, 1)
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    want = {f"{k}:{m.start()}:{m.end()}" for k, p in plain.items() for m in re.finditer(p, text)}
    assert want <= set(spans(documents, text)[0].split(","))


def test_nulls_empty_long_and_clashing_names(documents):
    long = "7" * 50_000 + " " + "a" * 200_000
    docs = documents([None, "", long, (3, "a@b.c"), (3, "a@b.c")], ["'x' as pii"])
    rows = sorted(find_personal_data(docs).select("doc_id", listed("pii").alias("s")).collect())
    assert [r.s for r in rows] == ["", "", "", "email:0:5", "email:0:5"]
    assert find_personal_data(docs.limit(0)).count() == 0


def test_redaction_joins_overlaps_and_keeps_the_rest(documents):
    docs = documents(["a +4 1.2.3.45 67890 b", "ü x@y.z!", None, "plain"])
    assert spans(documents, "a +4 1.2.3.45 67890 b") == ["phone:2:19,ip:5:13"]
    out = sorted(redact(find_personal_data(docs)).select("doc_id", "text").collect())
    assert [r.text for r in out] == ["a [PHONE] b", "ü [EMAIL]!", None, "plain"]
