"""Gates reject nothing that their patterns accept."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leadmill.llm import gates, page_lines, residue

PATTERNS = {
    **{f"line {k}": p for k, p in vars(page_lines).items() if isinstance(p, re.Pattern)},
    **{f"residue {k}": p for k, p in vars(residue).items() if isinstance(p, re.Pattern)},
    "odd": re.compile(r"(?:abc|de+f)?xyz(?:q|rst)+|\bfoo{2,}bar\b|^(?:one|two) three", re.IGNORECASE),
}
WORDS = sorted({w for p in PATTERNS.values() for w in re.findall(r"[^\W_]+", p.pattern)}) + ["...", ":", "(c) 2020", "©", "](/x)", "[a", "404", "<*>", "x x x x", "ſcripts", "K"]


ALL = gates.Gate(**{f"p{k}": p for k, p in enumerate(PATTERNS.values())})


def test_needed():
    assert gates.needed(re.compile("abc|defg")) == {"abc", "defg"}
    assert gates.needed(re.compile("abc|d")) is None
    assert gates.needed(re.compile(r"(?:foo)?\bbarbar\b(?:one|three)")) == {"barbar"}
    assert gates.needed(re.compile("x*")) is None


@pytest.mark.parametrize("name", PATTERNS)
def test_random_texts(name):
    pattern, gate, rng = PATTERNS[name], gates.Gate(p=PATTERNS[name]), random.Random(name)
    for _ in range(3000):
        text = rng.choice([" ", " ", ""]).join(rng.choice(WORDS) for _ in range(rng.randint(1, 9)))
        text = rng.choice([text, text.upper(), text.title()])
        if pattern.search(text):
            assert gate.may_match(text) & 1


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    mask = ALL.may_match(text)
    for k, p in enumerate(PATTERNS.values()):
        assert not p.search(text) or mask >> k & 1


def test_kinds_and_verdicts_with_and_without_gates(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    gated = [(page_lines.kind_of(t), residue.classify(t)) for t in texts]
    page_lines.kind_of.cache_clear()
    monkeypatch.setattr(gates.Gate, "may_match", lambda self, text: self.all)
    assert gated == [(page_lines.kind_of(t), residue.classify(t)) for t in texts]
    assert len({k for k, _ in gated}) > 6 and len({v for _, v in gated}) > 3
