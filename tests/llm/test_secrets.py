"""The network against kinds of secrets and of harmless text that its labelled set does not hold."""

import random

import numpy as np
import pytest
from brute import prose

from newstape.llm import secretscan as S

B62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
R = random.Random(9)
token = lambda n, letters=B62: "".join(R.choice(letters) for _ in range(n))
WORDS = "average column window garden station letter number river market weekly simple pattern history method object teacher winter".split()
#: what is planted, and how many of its last characters are the secret
SECRETS = {
    "bare base62-40": (lambda: token(40), 40), "ghp_": (lambda: "ghp_" + token(36), 36), "auth:": (lambda: "auth: " + token(40), 40),
    "Bearer": (lambda: "Bearer " + token(32), 32), "pwd=": (lambda: "pwd=" + token(20), 20),
    "upper-case hex": (lambda: token(32, "0123456789ABCDEF"), 32), "db_pass:": (lambda: "db_pass: " + token(10), 10),
    "letters only": (lambda: token(40, B62[:52]), 40),
}
HARMLESS = {
    "card": lambda: token(16, "0123456789"), "card with dashes": lambda: "-".join(token(4, "0123456789") for _ in range(4)),
    "mail": lambda: f"anna.muster{R.randrange(999)}@posteo{R.randrange(9)}.example.net", "colour": lambda: "colour: " + R.choice(["marigold", "turquoise", "lavender"]),
    "title": lambda: f"https://blog.example.org/archive/2019/{'-'.join(R.sample(WORDS, 4))}-{R.randrange(99)}.htm", "camel": lambda: "compute" + "".join(w.capitalize() for w in R.sample(WORDS, 4)) + "2",
    "library": lambda: f"/opt/share/perl5/{'/'.join(R.sample(WORDS, 3))}", "number": lambda: f"total={R.randrange(10**8, 10**9)}",
}


@pytest.fixture(scope="module")
def network():
    return S.fit(S.labelled_set(prose(3, 2000).split()))


def hits(network, text):
    out = []
    for a, b in S.candidates(text, S.rule_findings(text)):
        keyed = bool(S.KEYED.search(text[max(0, a - S.BEFORE) : a]))
        if network.score(np.stack(S.views(text, a, b))).max() >= network.least[0 if keyed else 1]:
            out.append((a, b))
    return out


@pytest.mark.parametrize("kind", SECRETS)
def test_recall_on_unknown_kinds(network, kind):
    make, size = SECRETS[kind]
    found = 0
    for k in range(100):
        planted = make()
        text = f"{prose(k, 15)} {planted} {prose(k + 500, 9)}"
        end = text.index(planted) + len(planted)
        found += any(a <= end - size and b >= end for a, b in hits(network, text))
    assert found >= 90


@pytest.mark.parametrize("kind", HARMLESS)
def test_harmless_kinds_are_left_alone(network, kind):
    assert sum(bool(hits(network, f"{prose(k, 15)} {HARMLESS[kind]()} {prose(k + 500, 9)}")) for k in range(100)) <= 10


def test_prose_is_left_alone(network):
    assert sum(len(hits(network, prose(k, 300).replace(" and", ": and"))) for k in range(200)) <= 2


def test_candidates():
    spans = lambda t: [t[a:b] for a, b in S.candidates(t, S.rule_findings(t))]
    assert spans("x pwd: abcdef, y") == ["abcdef"] and spans("pwd: abcde") == [] and spans('"k": "abc123"') == ["abc123"]
    assert spans("xyz" * 7) == [] and spans("xyz" * 8) == ["xyz" * 8] and spans("ab" * 7 + "_1") == ["ab" * 7 + "_1"]
    assert spans("x" * 100) == [] == spans("k = " + "=-" * 20)
    assert spans("password=abcdef k=uvwxyz1") == ["uvwxyz1"] and spans("") == [] and spans("::=:") == []
    long = "q=" + "xyz" * 10
    assert spans(long) == [long]


def test_findings_of_one_label_are_an_error():
    with pytest.raises(ValueError):
        S.fit([("token = abc", 8, 11, 1)])


def test_the_made_set_is_the_same_every_time():
    words = ["some", "words"]
    assert S.labelled_set(words, 50) == S.labelled_set(words, 50)
    assert all(0 <= a < b <= len(t) and b - a >= S.AFTER_SIGN for t, a, b, _ in S.labelled_set(words, 200))
