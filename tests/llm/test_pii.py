import random

import pytest

from tests.helpers import clashing
from tracewright.llm import pii

D = "doc_id long, text string"
FIRST = ["Marta", "Jonas", "Aiko", "Priya", "Tomás", "Ingrid", "Kwame", "Leila", "Sven", "Chiara", "Dmitri", "Noor"]
LAST = ["Kowalczyk", "Weidenfeller", "Tanaka", "Raghunathan", "Ferreira", "Halvorsen", "Mensah", "Haddad", "Lindqvist", "Moretti", "Volkov", "Rahman"]
#: Sentences around the values; none of their wording is in pii.py as a phrase.
WORDINGS = [
    ("email", "You can write to ", ["{f}.{l}@robotics-lab.org", "{f}_{l}@mail.uni-west.edu"], " about the dataset."),
    ("email", "The invoice went to ", ["{f}-{l}@handel.de", "{l}{n2}@post.example.com"], " yesterday."),
    ("email", "Reply under ", ["{f}.{l} [at] kontor [dot] net", "{f}.{l} (at) kontor.net"], ", thanks."),
    ("phone", "Our hotline is ", ["+1 650-253-{n4}", "+33 1 42 68 {n2} {n2}", "(415) 555-{n4}"], " on weekdays."),
    ("phone", "My mobile: ", ["+49 151 234{n5}", "0151 2345{n4}", "+81 3-1234-{n4}"], ", evenings only."),
    ("phone", "Sie erreichen uns telefonisch, Telefon ", ["030 9012{n4}", "+49 89 12{n5}"], " ist besetzt."),
    ("idnum", "His social security number, ", ["5{n2}-{n2}-{n4}"], ", appeared in the form."),
    ("idnum", "She showed passport ", ["C{n8}", "AB{n7}"], " to the guard."),
    ("idnum", "Personalausweis Nr. ", ["L{n8}", "T{n8}"], " liegt vor."),
    ("address", "Parcels go to the office at ", ["{n2} Maple Grove Avenue, Portland", "{n2}B Baker Street, London", "{n3} Ocean View Drive"], " every morning."),
    ("address", "Er wohnt in der ", ["Lindenstraße {n2}, 10969 Berlin", "Goethestr. {n2}", "Hauptstraße {n2}a"], " seit Mai."),
    ("address", "The Paris lab moved to ", ["{n2} Rue de la Paix, Paris", "{n2} Avenue Victor Hugo, Lyon"], " last spring."),
    ("name", "Yesterday ", ["{F} {L}"], " calibrated the arm twice."),
    ("name", "We spoke with ", ["{F} {L}", "{F0}. {L}"], " during lunch."),
    ("name", "Questions go to Professor ", ["{F} {L}"], " in the annex."),
    ("name", "The plan is from ", ["{F} {L}", "{L}, {F}"], ", second draft."),
    ("name", "Then ", ["{F} {L}", "{F} {F0}. {L}"], " said the torque was low."),
]
PLAIN = [
    "The peg slid into the hole at the third try.", "Serial number 254-44-9007 belongs to the amplifier.", "Build 20240311 failed on 2024-03-11 at noon.", "We counted 1204551 rows and 88 nulls.", "Order 4415-22-118 came with pads.",
    "On Monday the Marlow jig was moved beside the Hampton plate.", "Version 10.4.2.17 of the driver is out.", "Force rose to 253 N and torque to 12 Nm.", "See the @dataclass in run 9.9.9 for details.", "Mask 255.255.169.0 was wrong, port 8080 too.",
    "Der Greifer blieb stehen, Lauf 132 wurde wiederholt.", "Drive down lane 9 and turn left at bay 4.",
]


def fill(form, r):
    f, l = r.choice(FIRST), r.choice(LAST)  # noqa: E741
    ascii_ = lambda x: x.lower().replace("á", "a")
    out = form.format(f=ascii_(f), l=ascii_(l), F=f, L=l, F0=f[0], **{f"n{k}": f"{{n{k}}}" for k in (2, 3, 4, 5, 7, 8)})
    for k in (2, 3, 4, 5, 7, 8):
        while f"{{n{k}}}" in out:
            out = out.replace(f"{{n{k}}}", str(r.randrange(10 ** (k - 1), 10**k)), 1)
    return out


def corpus(n=500, seed=0):
    """Documents with planted values and their true (doc_id, kind, start)."""
    r = random.Random(seed)
    docs, truth = [], set()
    for i in range(n):
        text = ""
        for _ in range(6):
            if r.random() < 0.5:
                text += r.choice(PLAIN)
            else:
                kind, before, forms, after = r.choice(WORDINGS)
                truth.add((i, kind, len(text) + len(before)))
                text += before + fill(r.choice(forms), r) + after
            text += r.choice([" ", "\n"])
        docs.append((i, text))
    return docs, truth


@pytest.fixture(scope="module")
def planted():
    return corpus()


def test_found_on_unseen_wordings(spark, planted):
    docs, truth = planted
    got = {tuple(r) for r in pii.found(clashing(spark.createDataFrame(docs, D))).collect()}
    text = dict(docs)
    show = lambda x: [(k, text[d][max(0, s - 20) : s + 30]) for d, k, s in sorted(x)[:8]]
    for kind in pii.KINDS:
        t, g = {x for x in truth if x[1] == kind}, {x for x in got if x[1] == kind}
        assert len(g & t) / len(t) >= 0.9, (kind, len(g & t), len(t), show(t - g))
        assert len(g & t) / len(g) >= 0.9, (kind, len(g & t), len(g), show(g - t))


def test_wordings_are_not_in_the_source():
    import inspect

    source = inspect.getsource(pii).lower()
    for _, before, _, after in WORDINGS:
        for phrase in (before, after):
            words = phrase.lower().strip(" ,.:").split()
            assert len(words) < 2 or " ".join(words) not in source, phrase


def test_redaction_keeps_the_rest(spark, planted):
    docs, _ = planted
    rows = [*docs, docs[0], (7, None), (None, "Write to marta.tanaka@robotics-lab.org today.")]
    out = [tuple(r) for r in pii.redact(spark.createDataFrame(rows, D)).collect()]
    assert len(out) == len(rows)
    joined = "\n".join(t or "" for _, t in out)
    assert "@robotics-lab" not in joined and "You can write to [EMAIL] about the dataset." in joined
    assert "We spoke with [NAME] during lunch." in joined and "The peg slid into the hole at the third try." in joined
    assert (None, "Write to [EMAIL] today.") in out and (7, None) in out


def test_redaction_puts_texts_together_by_code_points(spark):
    docs = [(1, "Überprüft 🙂 von mira.harrowick@cellops.test, 🙂 dann +44 20 7946 0012!"), (2, "kein Wert"), (3, "")]
    got = dict(map(tuple, pii.redact(spark.createDataFrame(docs, D)).collect()))
    assert got[1].startswith("Überprüft 🙂 von [EMAIL], 🙂 dann ") and got[2] == "kein Wert" and got[3] == ""


def test_em_finds_the_unreliable_labeler():
    r = random.Random(0)
    votes = {}
    for _ in range(4000):
        true = r.random() < 0.4
        v = "".join("+" if (r.random() < (0.95 if true else 0.05)) else "-" for _ in range(3)) + r.choice("+-")
        votes[v] = votes.get(v, 0) + 1
    post, model = pii.reliabilities(sorted(votes.items()))
    assert post["+++-"] > 0.9 and post["---+"] < 0.1
    assert abs(model["rates"][0][3][0] - model["rates"][1][3][0]) < 0.15 < model["rates"][0][0][0] - model["rates"][1][0][0]


def test_awkward_cases(spark):
    docs = [(1, None), (2, ""), (3, "x" * 300_000 + " mira.harrowick@cellops.test"), (4, "Überprüft 🙂 von mira.harrowick@cellops.test"), (4, "Überprüft 🙂 von mira.harrowick@cellops.test")]
    got = sorted(tuple(r) for r in pii.found(spark.createDataFrame(docs, D)).collect())
    assert got == [(3, "email", 300_001), (4, "email", 16), (4, "email", 16)]
    assert pii.found(spark.createDataFrame([], D)).count() == 0 and pii.redact(spark.createDataFrame([], D)).count() == 0


def test_gazetteer_does_not_saturate(spark):
    """Words that stand in few addresses but in many names are not known; thousands of
    different name parts change nothing for a word that is in no address."""
    email, name = pii.KINDS.index("email"), pii.KINDS.index("name")
    rows = [(email, [f"part{i}", f"other{i}"]) for i in range(3000)] + [(name, ["part7", "stranger"])] * 10 + [(name, ["other9", "part9"])] * 200
    known = {r["word"] for r in pii.gazetteer(spark.createDataFrame(rows, "kind int, words array<string>")).collect()}
    assert known == {"part7"}


def test_candidates_come_from_shape_alone():
    at = lambda t: {(c[0], t[c[1] : c[2]]) for c in pii.candidates(t, set())}
    assert ("name", "Marta Kowalczyk") in at("Yesterday Marta Kowalczyk calibrated the arm")
    assert ("name", "Jonas Weidenfeller") in at("We spoke with Jonas Weidenfeller")
    assert ("phone", "5551234567") in at("Contact me: 5551234567")
    assert ("address", "12 Rue de la Paix, Paris") in at("12 Rue de la Paix, Paris")
    assert ("address", "221B Baker Street, London") in at("221B Baker Street, London")


def test_spelled_addresses():
    for t in ("to a.b [at] nordwerk [dot] test now", "an kpellsund @ cellops.invalid x", "segor.s AT cellops DOT invalid", "x_y+rig (at) uni-arm.example", "<A-B@UNI-ARM.EXAMPLE>"):
        assert [c[0] for c in pii.candidates(t, set()) if c[0] != "name"] == ["email"], t
    assert "email" not in [c[0] for c in pii.candidates("source_stamp@388 Hz, see @dataclass and look at the dot", set())]
