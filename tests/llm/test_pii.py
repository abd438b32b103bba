"""Personal data against the plain patterns, and disguises."""

import random
import re

import pytest

from docloom.llm import pii
from tests.llm.conftest import ROWS

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_plain_spans_are_the_patterns(texts):
    rng = random.Random(1)
    given = ["".join(rng.choice("ab123456789000.@+-  ()_%") for _ in range(rng.randint(0, 50))) for _ in range(30000)]
    for text in [*given, *texts.values()]:
        assert pii.found_in(text) == plain(text)


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("to jane (at) example [dot] org!", "email", "jane (at) example [dot] org"),
        ("to jane at example dot co dot uk", "email", "jane at example dot co dot uk"),
        ("to jаne@exаmple.org", "email", "jаne@exаmple.org"),
        ("to jane＠example．org now", "email", "jane＠example．org"),
        ("call plus four four one two three four five six seven", "phone", "plus four four one two three four five six seven"),
        ("call +４４ 20 7946 0958", "phone", "+４４ 20 7946 0958"),
        ("card ４１１１ １１１１ １１１１ １１１１.", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("card Four-one-one-one " + "one " * 11 + "one", "card", "Four-one-one-one " + "one " * 11 + "one"),
        ("at 10.0.0​.1 there", "ip", "10.0.0​.1"),
        ("to jane [at] example dot com", "email", "jane [at] example dot com"),
        ("to jane (at) example dot co dot uk", "email", "jane (at) example dot co dot uk"),
        ("to jane at example [dot] com", "email", "jane at example [dot] com"),
        ("to jane@example dot com", "email", "jane@example dot com"),
        ("to jane at mail.example dot com", "email", "jane at mail.example dot com"),
        ("to jane.doe at example.com", "email", "jane.doe at example.com"),
    ],
)
def test_disguises(text, kind, part):
    base, more = pii.spans_of(text)
    start = text.index(part)
    assert (kind, start, start + len(part)) in more
    assert part not in pii.redacted(text, base + more)


@pytest.mark.parametrize(
    "text",
    ["we met at noon", "look at the dot on the map", "one two three four", "a (at) b", "une élève, straße, mañana № 5 ½ m²", "f(x) < g{y}"],
)
def test_prose_is_left_alone(text):
    assert pii.spans_of(text) == ([], [])


@pytest.mark.parametrize(
    "part",
    [f"jane at firm dot {x}" for x in "nz za kr gr tv me cz online museum xn--p1ai".split()]
    + ["jane at mail dot firm dot lan", "jane_7 at firm dot lan", "jane (at) firm dot lan", "jane@firm dot lan", "jane at firm [dot] lan", "jane at firm dot com"],
)
def test_endings(part):
    assert pii.spans_of(f"to {part}, please")[1] == [("email", 3, 3 + len(part))]


@pytest.mark.parametrize("text", ["look at the dot me and you see", "stare at a dot and dot the i", "jane at firm dot lan", "it is at this dot now"])
def test_endings_of_prose(text):
    assert pii.spans_of(text) == ([], [])


@pytest.mark.parametrize("text", ["buy it at example.com", "we sat at dot com", "x at y.z"])
def test_half_a_disguise_is_prose(text):
    assert pii.spans_of(text) == ([], [])


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("at 192 dot 168 dot 0 dot 1 there", "ip", "192 dot 168 dot 0 dot 1"),
        ("at one nine two dot one six eight dot zero dot one there", "ip", "one nine two dot one six eight dot zero dot one"),
        ("at one nine two [dot] one six eight [dot] zero [dot] one", "ip", "one nine two [dot] one six eight [dot] zero [dot] one"),
        ("at 10.zero.0.one", "ip", "10.zero.0.one"),
        ("call plus 4 four 2 zero 79 four 6 zero 958", "phone", "plus 4 four 2 zero 79 four 6 zero 958"),
        ("call plus 44 20 7946 0958", "phone", "plus 44 20 7946 0958"),
        ("call +44 2 zero 7946 zero 958", "phone", "+44 2 zero 7946 zero 958"),
        ("card 4 one 11 1111 one 111 11 one 1", "card", "4 one 11 1111 one 111 11 one 1"),
        ("card ４ one 11 1111 one 111 11 one 1", "card", "４ one 11 1111 one 111 11 one 1"),
        ("card ４１１１ １１１１ １１１１ １１１１ two times", "card", "４１１１ １１１１ １１１１ １１１１"),
    ],
)
def test_digits_among_numerals(text, kind, part):
    base, more = pii.spans_of(text)
    start = text.index(part)
    assert (kind, start, start + len(part)) in more
    assert part not in pii.redacted(text, base + more)


@pytest.mark.parametrize("text", ["in 2020 one of 12 people", "page 3 dot 4, two or 5", "a bonus plus 12000000 dollars", "3 plus 44 20 7946 0958"])
def test_numbers_in_prose_are_left_alone(text):
    assert pii.spans_of(text) == ([], [])


def test_words_beside_whole_addresses_are_not_theirs():
    for text, span in (("room 4 two@example.com", ("email", 7, 22)), ("10.0.0.1 two hosts", ("ip", 0, 8))):
        assert pii.spans_of(text) == ([span], [])


def test_long_mixed_runs_end():
    for text in ("1 " * 100_000 + "one", "one " * 50_000, "1 dot " * 30_000, "one" + " " * 200_000 + "dot", "one (" * 30_000, "a@b dot " * 30_000):
        pii.spans_of(text)


def test_documents_gain_nothing(texts):
    assert all(not pii.spans_of(t)[1] for t in texts.values() if not pii.found_in(t))


def test_spans_map_back_through_several_rewritings():
    text = "х​ two six (at) ｅxample [.] com"
    rewritten = pii.Rewritten(text)
    for transduce in (pii.look_alikes, pii.spelled_digits, pii.bracketed):
        rewritten.replace(transduce(rewritten.text))
    assert rewritten.text == "x 26@example.com"
    assert "".join(text[a] for a in rewritten.first[-3:]) == "com"
    assert text[rewritten.first[4] : rewritten.last[4]] == " (at) "
    assert len(rewritten.text) == len(rewritten.first) == len(rewritten.last)


def test_long_runs_end():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "+1" + " " * 200_000, "@" * 100_000, "a at " * 30_000):
        pii.spans_of(text)


def test_find_and_redact(awkward):
    rows = pii.find(awkward.drop("spans")).collect()
    assert len(rows) == len(ROWS)
    mail = next(r for r in rows if r["doc_id"] == 6)
    found = [(s["kind"], mail["text"][s["start"] : s["end"]], s["plain"]) for s in mail["spans"]]
    assert found == [
        ("email", "jo@example.com", True),
        ("email", "jane (at) example [dot] org", False),
        ("ip", "10.0.0.1", True),
    ]
    assert all(r["spans"] == [] for r in rows if r["doc_id"] != 6)
    clean = pii.redact(awkward)
    assert clean.columns == awkward.columns
    assert clean.where("doc_id = 6").first()["text"] == "mail [EMAIL] or [EMAIL], [IP]"
    assert clean.where("text IS NULL").count() == 2
    assert pii.find(awkward.limit(0)).count() == 0
