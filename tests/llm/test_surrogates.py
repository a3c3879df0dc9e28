"""Op 1: what is replaced, consistency, distinctness, and that no Python runs."""
import re

from metroscope.llm import surrogates as S

ROWS = [
    (1, "Mail john.doe@Example.com or JOHN.DOE@EXAMPLE.COM, call +1 (706) 555-3138 / +1 706-555-3138."),
    (2, "Card 4111 1111 1111 1111 and 4111111111111111, not 4111111111111112 or 4111."),
    (3, 'Mr. John Smith met Mrs. Smith and Mary Jones at 10.1.2.3; token = "ab59b03a9d0189cc1ff5513a5b496212436c9831"###'),
    (4, "Г-жа Анна Каренина и Мария Каренина, SSN 123-45-6789, version 2.0. 1.2.3.4.5 999.1.1.1"),
    (5, "john.doe@example.com +1 (826) 555-4081 190.137.223.204 du"),
]


KEY = "test"


def replaced(docs, key=KEY, **kw):
    return {r.doc_id: r.text for r in S.replace_private(docs, key, **kw).collect()}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def test_types_formats_and_coreference(docs_of):
    out = replaced(docs_of(ROWS))
    mail = re.match(r"Mail ([a-z]{4}\.[a-z]{3}@[a-z]{7}\.com) or ([A-Z.@]+), call \+1 \((\d{3})\) (\d{3})-(\d{4}) / \+1 (\d{3})-(\d{3})-(\d{4})\.", out[1])
    assert mail and mail[2] == mail[1].upper() and mail.group(3, 4, 5) == mail.group(6, 7, 8)
    assert out[5].startswith(mail[1] + " ") and mail.group(3, 4, 5) != ("706", "555", "3138")
    card = re.match(r"Card (4\d{3} \d{4} \d{4} \d{4}) and (\d{16}), not 4111111111111112 or 4111\.", out[2])
    assert card and card[1].replace(" ", "") == card[2] != "4111111111111111" and luhn(card[2])
    names = re.match(r'Mr\. (\w+) (\w+) met Mrs\. (\w+) and (\w+) (\w+) at (\d+\.\d+\.\d+\.\d+); token = "([0-9a-f]{40})"###', out[3])
    assert names and names[2] == names[3] and names[5] != names[2]
    men = {n for (s, g), own in S.NAMES.items() if (s, g) == ("latin", "m") for n in own}
    women = {n for (s, g), own in S.NAMES.items() if (s, g) == ("latin", "f") for n in own}
    assert names[1] in men and names[4] in women and names[1] != "John" and names[4] != "Mary"
    assert all(int(p) < 256 for p in names[6].split("."))
    cyr = re.match(r"Г-жа ([А-ЯЁ][а-яё]+) ([А-Я][а-я]+) и ([А-ЯЁ][а-яё]+) ([А-Я][а-я]+), SSN (\d{3}-\d{2}-\d{4}), version 2\.0\. 1\.2\.3\.4\.5 999\.1\.1\.1$", out[4])
    assert cyr and cyr[2] == cyr[4] != "Каренина" and cyr[1] != cyr[3] and cyr[5] != "123-45-6789"


def test_key_decides_and_runs_repeat(docs_of):
    docs = docs_of(ROWS)
    assert replaced(docs) == replaced(docs)
    assert replaced(docs)[1] != replaced(docs, key="another")[1]


def test_distinct_even_when_draws_collide(spark):
    """900 first names for 16 listed ones, and 3,000 addresses: all different."""
    names = [("given-m-latin", f"name{i}") for i in range(900)] + [("ip", f"10.{i >> 8}.{i & 255}.1") for i in range(3000)]
    table = S.assign(spark.createDataFrame(names, "type string, norm string"), "k").collect()
    assert len(table) == len(names)
    assert len({(r.type, r.surrogate) for r in table}) == len(names)
    assert not {(r.type, r.surrogate) for r in table} & set(names)
    assert all(re.fullmatch(r"[a-zéçüíá]+", r.surrogate) for r in table if r.type.startswith("given"))


def test_nothing_private_left(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    old = {r.doc_id: r.text for r in docs.collect()}
    new = replaced(docs)
    assert old.keys() == new.keys()
    private = {m for t in old.values() for m in re.findall(r"[\w.]+@[\w.]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|\b[0-9a-f]{40}\b", t or "")}
    private |= {m for t in old.values() for m in re.findall(r"(?<!\d)\d{16}(?!\d)", t or "") if luhn(m)}
    assert private and not [m for m in private for t in new.values() if t and m in t]
    plain = [i for i, t in old.items() if t and not re.search(r"[@\d]", t)]
    assert plain and all(old[i] == new[i] for i in plain)


def test_awkward_rows(docs_of, awkward):
    rows = awkward + [(8, "a@b.org and a@b.org"), (8, "a@b.org and a@b.org"), (None, "c@d.org")]
    for extra in (False, True):
        docs = docs_of(rows, extra)
        out = S.replace_private(docs, KEY, count_col="n_replaced")
        assert out.columns == [*docs.columns, "n_replaced"]
        got = out.collect()
        assert len(got) == len(rows)
        assert {(r.doc_id, r.text) for r in got if not r.n_replaced} == set(awkward)
        twice = [r for r in got if r.doc_id == 8]
        assert len(twice) == 2 and twice[0].text == twice[1].text and all(r.n_replaced == 2 for r in twice)
    assert S.replace_private(docs_of([]), KEY).count() == 0


def test_hostile_texts(docs_of):
    """Texts that make careless patterns recurse or backtrack without end."""
    rows = [(1, "x@" + "a." * 60_000), (2, "1-" * 100_000), (3, "a@" * 100_000), (4, "1.2." * 50_000), (5, "0" * 300_000),
            (6, "Mr. " * 50_000), (7, "f" * 200_000), (8, "(" * 100_000 + "+1 " * 50_000), (9, "a@b.org " * 20_000)]
    out = replaced(docs_of(rows))
    assert len(out) == len(rows) and "a@b.org" not in out[9] and out[5] == rows[4][1]


def test_no_python_in_the_plan(spark, sf):
    plan = S.replace_private(spark.read.parquet(f"{sf}/documents.parquet"), KEY)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_numbers_beside_numbers(docs_of):
    """A card, phone or social security number is found whatever number stands beside it."""
    card, other, amex = "4111111111111111", "5500005555555559", "3782 822463 10005"
    spaced = "4111 1111 1111 1111"
    rows = [f"{card} 123", f"12/27 {card}", "706-555-3138 706-555-3139", "706-555-3138 2024", f"12 34 {spaced}", f"{spaced} {other} 99",
            "2024 706-555-3138", "2024 123-45-6789", f"{card} 10.1.2.3", f"{card} 12ab@x.org", f"7 {amex} 1 {spaced}-2",
            f"{card}-706-555-3138", f"{card} " + "1234567890123" + "abcdef0" * 4, f"{card} {card}", f"41 11 11 11 11 11 11 11 {spaced}"]
    private = [card, other, amex, spaced, "706-555-3138", "706-555-3139", "123-45-6789", "10.1.2.3", "12ab@x.org",
               "1234567890123" + "abcdef0" * 4, "41 11 11 11 11 11 11 11"]
    out = {r.doc_id: r for r in S.replace_private(docs_of(list(enumerate(rows))), KEY, count_col="n").collect()}
    for i, text in enumerate(rows):
        assert not [p for p in private if p in out[i].text], (text, out[i].text)
        assert re.sub("[0-9a-z]", "", out[i].text) == re.sub("[0-9a-z]", "", text)
    assert [out[i].n for i in range(len(rows))] == [1, 1, 2, 1, 1, 2, 1, 1, 2, 2, 2, 2, 2, 2, 2]
    new = out[0].text.split()[0]
    assert luhn(new) and out[0].text == f"{new} 123" and out[1].text == f"12/27 {new}" and out[13].text == f"{new} {new}"
    assert out[4].text.replace(" ", "") == f"1234{new}" and out[10].text.startswith("7 ") and out[10].text.endswith("-2")
    assert out[3].text.endswith(" 2024") and out[2].text.split()[0] == out[3].text.split()[0] == out[6].text.split()[1]
    kept = [(1, "4111111111111112 123"), (2, "1234 5678 9012 3456 7"[:14]), (3, "0" * 40 + "g"), (4, None)]
    assert replaced(docs_of(kept)) == dict(kept)


def test_phones_of_other_countries_and_titles_of_either_gender(docs_of):
    phones = ["+44 20 7946 0958", "+33 1 23 45 67 89", "+49 30 1234567", "(706)555-3138", "+49 (30) 1234567", "+7 495 123-45-67", "+442079460958"]
    rows = [f"call ({p}), or {p} 706-555-3139 now" for p in phones]
    rows += ["+1 706-555-3138 and 706-555-3138 and (706)555-3138, +17065553138", "+49 30 1234567 4111 1111 1111 1111",
             "Dr. Smith, Prof. Dr. Mary Jones, Herr Dr. Smith, Mary Jones; Д-р Каренина", "+49 30 1234567 10.1.2.3 a", "+1234567 +12 34 a"]
    out = replaced(docs_of(list(enumerate(rows))))
    for i, p in enumerate(phones):
        assert p not in out[i] and "706-555-3139" not in out[i], out[i]
        assert re.sub("[0-9]", "", out[i]) == re.sub("[0-9]", "", rows[i])
    assert re.sub(r"\D", "", out[0][:24]) == re.sub(r"\D", "", out[6][:20])
    same = re.fullmatch(r"\+1 (\d{3}-\d{3}-\d{4}) and (\d{3}-\d{3}-\d{4}) and (\(\d{3}\)\d{3}-\d{4}), \+1(\d{10})", out[7])
    assert same and len({re.sub(r"\D", "", g) for g in same.groups()}) == 1 and same[1] != "706-555-3138"
    assert "4567" not in out[8] and "1111" not in out[8] and luhn(re.sub(r"\D", "", out[8])[-16:])
    names = re.fullmatch(r"Dr\. (\w+), Prof\. Dr\. (\w+) (\w+), Herr Dr\. (\w+), (\w+) (\w+); Д-р ([А-Я][а-я]+)", out[9])
    assert names and names[1] == names[4] != "Smith" and names.group(2, 3) == names.group(5, 6) and names[7] != "Каренина"
    assert names[2] != "Mary" and names[3] != "Jones" and "10.1.2.3" not in out[10] and out[11] == rows[11]


def test_dense_addresses_end_soon(spark):
    """All two-letter addresses of one domain: no free one of that length is left."""
    norms = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}@mail.com" for i in range(676)] + [f"{chr(97 + i)}@one.com" for i in range(26)]
    table = S.assign(spark.createDataFrame([("email", n) for n in norms], "type string, norm string"), "k").collect()
    assert sorted(r.norm for r in table) == sorted(norms)
    new = [r.surrogate for r in table]
    assert len(set(new)) == len(norms) and not set(new) & set(norms) and all(re.fullmatch(r"[a-z]+@[a-z]+\.com", x) for x in new)


def test_full_number_formats_are_handed_round(spark):
    """Every number of a format is real: each entity gets another one's."""
    numbers = [("ssn", f"{i:03d}") for i in range(1000)] + [("ssn", f"{i:09d}") for i in range(50)] + [("phone", f"3{i:02d}") for i in range(0, 100, 1)]
    table = S.assign(spark.createDataFrame(numbers, "type string, norm string"), "k").collect()
    assert sorted((r.type, r.norm) for r in table) == sorted(numbers)
    assert len({(r.type, r.surrogate) for r in table}) == len(numbers)
    assert all(r.surrogate != r.norm and len(r.surrogate) == len(r.norm) for r in table)
    assert all(r.surrogate[0] == "3" for r in table if r.type == "phone")
    free = {r.surrogate for r in table if len(r.norm) == 9}
    assert not free & {n for _, n in numbers}


def test_no_table_of_real_data_is_left(spark, docs_of):
    import pathlib

    from metroscope.session import shared_root

    root = pathlib.Path(shared_root(spark).removeprefix("file:"))
    before = {p.name for p in root.iterdir()}
    out = S.settled_private(docs_of(ROWS), KEY)
    left = {p.name for p in root.iterdir()} - before
    assert [n for n in left if n.startswith("surrogate-rows")] and not [n for n in left if n.startswith("private")]
    assert {r.doc_id: r.text for r in out.collect()} == replaced(docs_of(ROWS))


def test_a_key_is_needed(docs_of):
    import pytest

    with pytest.raises(ValueError, match="key"):
        S.replace_private(docs_of(ROWS), "")


def test_every_mention_against_a_plain_replacer(spark, sf, docs_of):
    """A plain walk through every text: pieces between mentions stay, a mention's replacement is
    the same wherever it stands, of its own kind, shared by no other entity and no real one."""
    import regex

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()} | {100_000 + i: t for i, t in ROWS}
    new = replaced(docs_of(list(docs.items())))
    pattern = regex.compile(S.PATTERN)
    kinds = {"email": S.EMAIL, "ip": S.IPV4, "ssn": S.SSN, "phone": S.PHONE, "secret": S.SECRET}
    given, entities = {}, {}

    def kind(m):
        return next((k for k, p in kinds.items() if regex.fullmatch(p, m)), None)

    for i, text in docs.items():
        for m in pattern.finditer(text):
            if k := kind(m[0]):
                norm = re.sub(r"\D", "", m[0])[-10:] if k == "phone" and len(re.sub(r"\D", "", m[0])) == 11 else (
                    m[0].lower() if k in ("email", "secret", "ip") else re.sub(r"\D", "", m[0]))
                entities.setdefault((k, norm), set()).add((i, m[0]))
    private = {n for _, n in entities}
    shape = lambda x: re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", x)))
    for (k, norm), places in entities.items():
        for i, said in places:
            assert said not in new[i], (k, said)
    # texts of such mentions only: read the replacements off between the pieces that stay
    norm = lambda k, x: x.lower() if k in ("email", "secret", "ip") else re.sub(r"\D", "", x)[-10:]
    for i, text in docs.items():
        found = list(pattern.finditer(text))
        if not 0 < len(found) <= 6 or not all(kind(m[0]) for m in found):
            continue
        ends = [0, *[m.end() for m in found]]
        pieces = [text[a:m.start()] for a, m in zip(ends, found)] + [text[ends[-1]:]]
        if not all(re.search("[^\\W\\d]{2}", x) for x in pieces[1:-1]):
            continue  # nothing but digits or blanks between two mentions: no telling them apart again
        read = re.fullmatch("(.+?)".join(map(re.escape, pieces)), new[i], re.S)
        assert read
        for m, got in zip(found, read.groups()):
            k = kind(m[0])
            assert kind(got) == k and norm(k, got) not in private
            if k in ("phone", "ssn"):
                assert shape(got) == shape(m[0])
            assert given.setdefault((k, norm(k, m[0])), norm(k, got)) == norm(k, got)
    assert len(given) > 9 and len(set(given.values())) == len(given)
