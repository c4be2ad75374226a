import re

import pytest

from devpulse.llm import surrogates
from devpulse.llm.surrogates import assign, replace_entities


def replaced(frame, *texts, key="k"):
    rows = replace_entities(frame(list(enumerate(texts))), key).orderBy("doc_id").collect()
    return [r.text for r in rows]


def luhn_ok(number):
    digits = [int(c) for c in reversed(re.sub(r"\D", "", number))]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_format_is_kept(frame):
    text = "a bo.42@m8.example.com b +1 (724) 555-7058 c 4111 1111 1111 1111 d 42.144.35.254 e 123-45-6789 f DE44 5001 0517 5407 3249 31 g"
    (new,) = replaced(frame, text)
    form = re.compile(
        r"a [a-z]{2}\.\d\d@[a-z]\d\.[a-z]{7}\.example b \+1 \(\d{3}\) \d{3}-\d{4} c (4\d{3} \d{4} \d{4} \d{4}) "
        r"d \d+\.\d+\.\d+\.\d+ e 9\d\d-\d\d-\d{4} f DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d g"
    )
    assert form.fullmatch(new) and luhn_ok(form.fullmatch(new)[1])
    assert not set(re.findall(r"\d{4}", new)) & set(re.findall(r"\d{4}", text))


def test_one_entity_has_one_surrogate_everywhere(frame):
    a, b, c = replaced(
        frame, "x@y.example.com and X@Y.EXAMPLE.COM", "x@y.example.com 4111111111111111", "4111 1111 1111 1111 z@y.example.com"
    )
    first, _, second = a.split()
    assert second == first.upper() and b.split()[0] == first
    card, other = b.split()[1], c.rsplit(" ", 1)
    assert other[0].replace(" ", "") == card
    assert other[1].split("@")[1] == first.split("@")[1] and other[1] != first


def test_names_keep_gender_script_and_parts(frame):
    (new,) = replaced(frame, "Mr. John Smith, Mrs Smith, Dr John SMITH, Mary Smith, Госпожа Петрова")
    parts = re.fullmatch(r"Mr\. (\w+) (\w+), Mrs (\w+), Dr (\w+) (\w+), (\w+) (\w+), Госпожа ([а-яА-Я]+)", new).groups()
    assert parts[1] == parts[2] == parts[6] and parts[4] == parts[1].upper()
    assert parts[0] == parts[3] and parts[0].endswith("n") and parts[5].endswith("lia")


@pytest.mark.parametrize("written", ["+44 20 7946 0958", "(555) 123-4567", "555-123-4567", "+15551234567", "+49 (30) 901820"])
def test_telephone_numbers(frame, written):
    (new,) = replaced(frame, f"call {written}, please")
    assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", f"call {written}, please")
    assert written not in new and new[5:7] == written[:2] or written[0] != "+"


def test_keys_differ(frame):
    assert replaced(frame, "x@y.example.com", key="1") != replaced(frame, "x@y.example.com", key="2")


@pytest.mark.parametrize("short", [("ssn", 9), ("surname latin", 3)])
def test_collisions_are_solved(spark, monkeypatch, short):
    """A narrow choice of surrogates: distinct entities still get distinct ones, none an original."""
    kind, _ = short
    narrow = lambda: surrogates.F.expr("cast(400 + pmod(xxhash64(h), 600) as string)")
    monkeypatch.setattr(surrogates, "surrogate", narrow)
    entities = spark.range(250).selectExpr(f"'{kind}' as kind", "cast(id + 300 as string) as norm")
    rows = assign(entities, "k").collect()
    made = {r.surrogate for r in rows}
    assert len(rows) == len(made) == 250 and not made & {r.norm for r in rows}


def test_what_only_looks_alike_stays(frame):
    texts = ["plain text 1.2.3 and 12345", "version 1.2.3.4.5", "Mr and Mrs", "a@b", "x" * 200_000, "no. 300.1.1.1"]
    assert replaced(frame, *texts) == texts


def test_odd_rows(odd):
    out = replace_entities(odd, "k")
    assert sorted(str((r.doc_id, r.text, r.score)) for r in out.collect()) == sorted(
        str((r.doc_id, r.text, r.score)) for r in odd.collect()
    )
    assert replace_entities(odd.limit(0), "k").count() == 0
    twice = odd.withColumn("text", surrogates.F.lit("x@y.example.com")).withColumn("kinds", surrogates.F.lit(3))
    rows = replace_entities(twice, "k").collect()
    assert len(rows) == odd.count() and len({r.text for r in rows}) == 1 and rows[0].kinds == ["email"]


def test_more_entities_than_short_surrogates(spark, monkeypatch):
    """Names, letters of one domain and addresses of one network that outnumber their first choice."""
    monkeypatch.setattr(surrogates, "TRIES", 2)
    names = spark.range(33_500).selectExpr("'n latin' as kind", "concat('given', id) as norm")
    mails = spark.range(40).selectExpr("'email' as kind", "concat('a@x.', lpad(conv(id, 10, 26), 2, 'a')) as norm")
    hosts = spark.range(33_500).selectExpr("'ip' as kind", "concat_ws('.', '192.168', 1 + id div 254, 1 + id % 254) as norm")
    rows = assign(names.union(mails).union(hosts), "k").collect()
    made = {(r.kind, r.surrogate) for r in rows}
    assert len(rows) == len(made) == 33_500 + 40 + 33_500
    assert not made & {(r.kind, r.norm) for r in rows}
    assert all(re.fullmatch(r"(192\.168|10\.\d+)\.\d+\.\d+", r.surrogate) for r in rows if r.kind == "ip")


def test_one_person_stays_one(frame):
    """Possessives, and the surname alone where the text names the person."""
    (new, other) = replaced(
        frame, "Dr John Smith met Mr Smith. Smith said hello. Mr Smith's car and John Smith’s dog. Smithson stays.", "Smith alone"
    )
    form = r"Dr (\w+) (\w+) met Mr (\w+)\. (\w+) said hello\. Mr (\w+)'s car and (\w+) (\w+)’s dog\. Smithson stays\."
    given, *rest = re.fullmatch(form, new).groups()
    assert {rest[0]} == {rest[1], rest[2], rest[3], rest[5]} and rest[0] != "Smith"
    assert given != "John" and rest[4] == "".join(rest[4]) and other == "Smith alone"


def test_further_surnames(frame):
    (new,) = replaced(frame, "Mrs. María José García López and García-Ruiz wrote to Dr. J. R. O’Neil and Mr O'Neil")
    form = r"Mrs\. (\w+) (\w+) (\w+) (\w+) and García-Ruiz wrote to Dr\. J\. R\. O’(\w+) and Mr O'(\w+)"
    names = re.fullmatch(form, new).groups()
    assert not set(names) & {"María", "José", "García", "López", "Neil"} and names[4] == names[5]
    assert len(set(names[:4])) == 4


def test_hyphens_announced_names_and_initials(frame):
    (new,) = replaced(frame, "Herr Müller-Lüdenscheid. My name is Priya Patel. Contact: Wei Q. Zhang; ask Zhang")
    names = re.fullmatch(r"Herr (\w+-\w+)\. My name is (\w+) (\w+)\. Contact: (\w+) Q\. (\w+); ask (\w+)", new).groups()
    assert not set(names) & {"Priya", "Patel", "Wei", "Zhang"} and names[4] == names[5]


def test_addresses_of_version_6_and_national_numbers(frame):
    one, two, three = replaced(frame, "at 2001:db8::8a2e:370:7334 now", "at 2001:0DB8:0:0:0:8A2E:370:7334, 020 7946 0958", "12:30:45 and a::b::c and 10:20")
    form = r"at (fd[0-9a-f]{2}(?::[0-9a-f]{4}){7})(?: now|, (0\d\d \d{4} \d{4}))"
    first = re.fullmatch(form, one)[1]
    second = re.fullmatch(form, two.lower())
    assert second[1] == first and second[2] != "020 7946 0958"
    assert three == "12:30:45 and a::b::c and 10:20"


def test_the_table_follows_from_the_key(spark):
    """Surrogates made again in Python, collisions and all; distinct over all entities."""
    import hashlib

    def domain(host, key):
        return hashlib.sha256("\u0001".join([key, "domain", host]).encode()).hexdigest()

    def letters(value, digest):
        out = []
        for i, c in enumerate(value):
            byte = int(digest[(2 * i) % 64 : (2 * i) % 64 + 2], 16)
            out.append(str(byte % 10) if c.isdigit() else chr(97 + byte % 26) if c.islower() else c)
        return "".join(out)

    norms = [f"{c}{i}@host{i % 3}.com" for c in "ab" for i in range(60)] + [f"x@h{i}.com" for i in range(30)]
    attempts = dict.fromkeys(norms, 0)
    while True:
        made = {}
        for norm, n in attempts.items():
            local, host = norm.split("@")
            host = host.rsplit(".", 1)[0]
            digest = hashlib.sha256("\u0001".join(["key", "email", norm, str(n)]).encode()).hexdigest()
            made[norm] = f"{letters(local + 'a' * (n // 4), digest)}@{letters(host, domain(host, 'key'))}.example"
        keepers = {}
        for norm in sorted(norms, key=lambda x: (attempts[x], x)):
            keepers.setdefault(made[norm], norm)
        lost = [x for x in norms if keepers[made[x]] != x or made[x] in attempts]
        if not lost:
            break
        for x in lost:
            attempts[x] += 1
    got = {r.norm: r.surrogate for r in assign(spark.createDataFrame([("email", x) for x in norms], "kind string, norm string"), "key").collect()}
    assert got == made and len(set(got.values())) == len(norms) and max(attempts.values()) > 0
