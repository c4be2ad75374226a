"""Surrogates for personal data: every entity gets a made-up value of its own kind.

Entities are e-mail addresses, IP addresses of both versions, telephone, card and social security
numbers, IBANs, and names: after a title, with a known given name, or after words that announce
one ("my name is", "Contact:").  A surrogate follows from a keyed hash of the entity's normal form,
so one entity has one surrogate in all documents and formats: numbers keep their punctuation,
telephone numbers their country code or leading zero, cards their first digit and a right check
digit, IBANs their country, private addresses their network, addresses of one domain share a
domain, names keep gender, script, capitals, apostrophes and hyphens, and parts of a name agree with
the whole.  A possessive is no part of a name.  Where a text names a person, the surname standing
alone in it is replaced as well.  Initials stay.

All distinct entities pass a collision check: no two of a kind share a surrogate and none equals
another's original; losers are hashed again until none is left.  What they choose from grows with
the attempts, so that there is an end: names and the local parts of e-mail addresses get longer,
and a private address that finds no place in its network in `TRIES` attempts leaves it, for
10.0.0.0/8 or, from that one and 127.0.0.0/8, for the reserved 240.0.0.0/4.

The key is the caller's and has no default: who has it can make the table again.

Everything is a Spark SQL expression.  Documents without entities aren't shuffled.  Null texts
stay null, empty ones empty; null ids stay null; repeated rows get the same text; an empty table
gives no rows.  Columns `text` and those added replace columns of the same name."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.llm.common import stored

# attempts after which names and e-mail addresses get longer by one syllable or letter, and those
# after which a private address leaves its network
LONGER = 4
TRIES = 16

# fixed values: titles and given names by gender, and what names are made of by script
TITLES = {
    "m": ("Mr", "Herr", "Señor", "Sr", "Monsieur", r"M\.", "Господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа"),
    "n": ("Dr", "Prof"),
}
GIVEN = {
    "m": ("James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Paul", "Hans", "Jürgen", "Klaus", "Pierre", "Jean", "Luis", "Carlos", "José", "Иван", "Сергей"),
    "f": ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Anna", "Maria", "Petra", "Sabine", "Marie", "Claire", "Carmen", "Lucía", "Анна", "Ольга"),
}
SYLLABLES = {
    "latin": ("ba", "be", "bo", "ca", "co", "da", "de", "do", "fa", "fe", "ga", "go", "la", "le", "li", "lo", "ma", "me", "mi", "mo", "na", "ne", "ni", "no", "ra", "re", "ri", "ro", "sa", "so", "ta", "to"),
    "cyrillic": ("ба", "бо", "ва", "во", "га", "го", "да", "до", "за", "зо", "ка", "ко", "ла", "ло", "ма", "мо", "на", "но", "па", "по", "ра", "ро", "са", "со", "та", "то", "фа", "фо", "ха", "хо", "ша", "шо"),
    "greek": ("βα", "βο", "γα", "γο", "δα", "δο", "θα", "θο", "κα", "κο", "λα", "λο", "μα", "μο", "να", "νο", "πα", "πο", "ρα", "ρο", "σα", "σο", "τα", "το", "φα", "φο", "χα", "χο", "ζα", "ζο", "ξα", "ξο"),
}
ENDINGS = {
    "latin": {"m": "n", "f": "lia", "n": "ris"},
    "cyrillic": {"m": "н", "f": "лия", "n": "рис"},
    "greek": {"m": "ς", "f": "λια", "n": "ρις"},
}

# words that announce a name; the blank behind them belongs to the pattern
CUES = ("name is", "Name:", "Contact:", "Author:", "Signed,", "signed by")
# a name's word: O'Neil, García-López; not the possessive behind it
NAME = r"\p{Lu}(?:['’]\p{Lu})?\p{L}+(?:-\p{Lu}\p{L}+)?"
INITIAL = r"\p{Lu}\."
TITLE = "|".join(t for some in TITLES.values() for t in some)
KNOWN = "|".join(n for some in GIVEN.values() for n in some)
ANNOUNCED = "(?:" + "|".join(f"(?<={c} )" for c in CUES) + ")"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?![\d.]?\d)",
    "ip6": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=(?:[0-9A-Fa-f]{1,4}:?:?){2,7}(?![0-9A-Za-z:]))(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "phone": r"(?<![\d+])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}|0\d{1,4}[ -]\d{3,4}[ -]\d{3,4}|\+\d{1,3}(?:[ .()-]{0,2}\d){6,12})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?!\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    # the look ahead saves trying every title and name at every letter
    "name": rf"(?<!\p{{L}})(?=\p{{Lu}})(?:(?:{TITLE})\.? (?:(?:{INITIAL}|{NAME}) ){{0,3}}{NAME}|(?:{KNOWN}) (?:(?:{INITIAL}|{NAME}) ){{0,2}}{NAME}|{ANNOUNCED}{NAME} (?:(?:{INITIAL}|{NAME}) )?{NAME})(?!\p{{L}})",
}
# every kind but addresses and names has two digits near each other
DIGITS = r"\d[ .()-]{0,2}\d|[0-9A-Fa-f]::?[0-9A-Fa-f]{1,4}:|:[0-9A-Fa-f]{1,4}::?[0-9A-Fa-f]|[0-9A-Fa-f]::[0-9A-Fa-f]"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# what announces a name is not in it, so a mention is looked at without
MENTIONS = {k: p.replace(ANNOUNCED, "") for k, p in PATTERNS.items()}
TITLED = rf"^(?:{TITLE})\.? "
BARE = rf"(?<!\p{{L}}){NAME}(?!\p{{L}})"


def one_of(values) -> str:
    return f"^(?:{'|'.join(values)})$"


def kind_of(mention: Column) -> Column:
    out = F.when(F.lit(False), "")
    for kind, pattern in MENTIONS.items():
        out = out.when(mention.rlike(f"^(?:{pattern})$"), kind)
    return out


def byte_of(h: str, at: str) -> str:
    """SQL: the byte of a 64-digit hexadecimal hash at a place, which may run past its end."""
    return f"cast(conv(substring({h}, 1 + (2 * ({at})) % 64, 2), 16, 10) as int)"


def shaped(value: str, h: str) -> str:
    """SQL: other letters and digits in the places of `value`'s, in the same case."""
    byte = byte_of(h, "i")
    return f"""array_join(transform(split({value}, ''), (c, i) -> case
        when c rlike '[0-9]' then cast({byte} % 10 as string)
        when c rlike '[a-z]' then char(97 + {byte} % 26)
        when c rlike '[A-Z]' then char(65 + {byte} % 26) else c end), '')"""


def hexadecimal(value: str, h: str) -> str:
    """SQL: as many other hexadecimal digits."""
    return f"array_join(transform(split({value}, ''), (c, i) -> lower(hex({byte_of(h, 'i')} % 16))), '')"


def full_address(text: str) -> str:
    """SQL: the 32 digits of an IP address of version 6."""
    groups = f"filter(split(g, ':'), x -> x <> '')"
    left, right = (f"transform(array({part}), g -> {groups})[0]" for part in (
        f"substring_index({text}, '::', 1)", f"if(instr({text}, '::') > 0, substring_index({text}, '::', -1), '')"))
    between = f"array_repeat('0', greatest(0, 8 - size({left}) - size({right})))"
    return f"lower(array_join(transform(concat({left}, {between}, {right}), x -> lpad(x, 4, '0')), ''))"


def luhn(digits: str, from_right: int) -> str:
    """SQL: the check sum of a string of digits; `from_right`: which place from the right, even or
    odd, is doubled."""
    return f"""aggregate(transform(reverse(filter(split({digits}, ''), c -> c rlike '[0-9]')), (c, i) ->
        case when i % 2 = {from_right} then 2 * cast(c as int) - if(cast(c as int) > 4, 9, 0)
             else cast(c as int) end), 0, (a, x) -> a + x)"""


def by_syllables(h: str, script: str, kind: str) -> str:
    array = "array(" + ", ".join(f"'{s}'" for s in SYLLABLES[script]) + ")"
    last = f"{3 if kind == 'surname' else 2} + cast(attempt div {LONGER} as int)"
    parts = f"transform(sequence(0, {last}), i -> {array}[{byte_of(h, 'i')} % 32])"
    ending = "''" if kind == "surname" else f"'{ENDINGS[script][kind]}'"
    return f"concat(array_join({parts}, ''), {ending})"


def surrogate() -> Column:
    """The surrogate of `norm`, of `kind`, by the hash `h` of this `attempt` and, for domains, `hd`."""
    local = f"concat(`local`, repeat('a', cast(attempt div {LONGER} as int)))"
    check = f"cast((10 - {luhn('body', 0)} % 10) % 10 as string)"
    cases = {
        "email": f"concat({shaped(local, 'h')}, '@', {shaped('host', 'hd')}, '.example')",
        "ip": f"""array_join(transform(split(norm, '[.]'), (o, i) -> case
            when attempt >= {TRIES} and norm rlike '^(10|127)[.]' and i = 0 then cast(240 + {byte_of('h', 'i')} % 15 as string)
            when attempt >= {TRIES} and norm rlike '^(192[.]168|172[.](1[6-9]|2[0-9]|3[01]))[.]' and i = 0 then '10'
            when attempt >= {TRIES} and i = 1 then cast(1 + {byte_of('h', 'i')} % 254 as string)
            when norm rlike '^(10|127)[.]' and i = 0 then o
            when norm rlike '^(192[.]168|172[.](1[6-9]|2[0-9]|3[01]))[.]' and i < 2 then o
            when i = 0 then cast(11 + {byte_of('h', 'i')} % 110 as string)
            else cast(1 + {byte_of('h', 'i')} % 254 as string) end), '.')""",
        "phone": f"concat(regexp_extract(norm, '^([+][0-9]+ )?', 0), {shaped(chr(96) + 'rest' + chr(96), 'h')})",
        "ip6": f"concat('fd', {hexadecimal('substring(norm, 3)', 'h')})",
        "ssn": f"concat('9', {shaped('substring(norm, 2)', 'h')})",
        "card": f"if({luhn('norm', 1)} % 10 = 0, concat(body, {check}), concat(body, cast({byte_of('h', '31')} % 10 as string)))",
        "iban": f"concat(substring(norm, 1, 2), {shaped('substring(norm, 3)', 'h')})",
    }
    out = F.when(F.lit(False), "")
    for kind, sql in cases.items():
        out = out.when(F.col("kind") == kind, F.expr(sql))
    for script in SYLLABLES:
        for part in ("surname", *ENDINGS[script]):
            out = out.when(F.col("kind") == f"{part} {script}", F.expr(by_syllables("h", script, part)))
    return out


def with_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """Adds `surrogate` to (kind, norm, attempt)."""
    keyed = lambda *c: F.sha2(F.concat_ws("\u0001", F.lit(key), *c), 256)
    return (
        entities.withColumn("h", keyed("kind", "norm", F.col("attempt").cast("string")))
        .withColumn("local", F.substring_index("norm", "@", 1))
        .withColumn("host", F.regexp_extract("norm", r"@(.*)\.[^.]*$", 1))
        .withColumn("hd", keyed(F.lit("domain"), "host"))
        .withColumn("rest", F.regexp_replace("norm", r"^[+][0-9]+ ", ""))
        .withColumn("body", F.expr(f"concat(substring(norm, 1, 1), {shaped('substring(norm, 2, length(norm) - 2)', 'h')})"))
        .withColumn("surrogate", surrogate())
        .select("kind", "norm", "attempt", "surrogate")
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) for distinct entities (kind, norm), collisions solved.

    Of entities that share a surrogate the one hashed least often keeps it, the first in order of
    ties; a surrogate that is some entity's original goes.  Ends when a round finds none."""
    found = entities.withColumn("attempt", F.lit(0))
    while True:
        named = stored(with_surrogates(found, key))
        keeps = named.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "norm")).alias("first"), F.count("*").alias("n"))
        shared = keeps.where("n > 1").select("kind", "surrogate", F.col("first.norm").alias("keeper"))
        taken = named.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("taken"))
        lost = stored(
            named.join(shared, ["kind", "surrogate"], "left")
            .join(taken, ["kind", "surrogate"], "left")
            .where("taken or norm <> keeper")
            .select("kind", "norm")
        )
        if lost.isEmpty():
            return named.select("kind", "norm", "surrogate")
        again = named.join(lost.withColumn("lost", F.lit(1)), ["kind", "norm"], "left")
        found = again.select("kind", "norm", (F.col("attempt") + F.coalesce("lost", F.lit(0))).alias("attempt"))


def parts_of(mentions: DataFrame) -> DataFrame:
    """Mentions (mention) by the entities they consist of: (mention, place, kind, norm, written).

    Of a name's words the last is a surname; the first of several is a given name, as are known
    ones, and the rest are surnames too."""
    m = F.col("mention")
    kind = kind_of(m)
    title = F.regexp_extract(m, TITLED, 0)
    gender = (
        F.when(F.exists("words", lambda w: w.rlike(one_of(GIVEN["f"]))), "f")
        .when(F.exists("words", lambda w: w.rlike(one_of(GIVEN["m"]))), "m")
        .when(title.rlike(one_of(x + r"\.? " for x in TITLES["f"])), "f")
        .when(title.rlike(one_of(x + r"\.? " for x in TITLES["m"])), "m")
        .otherwise("n")
    )

    def of_name(w: Column, i: Column) -> Column:
        script = F.when(w.rlike(r"\p{IsCyrillic}"), "cyrillic").when(w.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
        last = i == F.size("words") - 1
        given = ~last & ((i == 0) | w.rlike(one_of([*GIVEN["f"], *GIVEN["m"]])))
        named = F.when(w.rlike(f"^{INITIAL}$"), "initial").otherwise(
            F.concat_ws(" ", F.when(given, F.col("gender")).otherwise("surname"), script)
        )
        return entry(named, F.lower(F.regexp_replace(w, "['’]", "")), w)

    digits = F.regexp_replace(m, "[^0-9]", "")
    country = F.regexp_extract(m, r"^[+]([0-9]{1,3})", 1)
    norm = (
        F.when(kind == "email", F.lower(m))
        .when(kind == "ip", m)
        .when(kind == "ip6", F.expr(full_address("mention")))
        .when((kind == "phone") & (country != ""), F.concat(F.lit("+"), country, F.lit(" "), F.expr("substring(d, length(country) + 1)")))
        .when(kind.isin("phone", "ssn", "card"), digits)
        .otherwise(F.regexp_replace(m, " ", ""))
    )
    entry = lambda k, n, w: F.struct(k.alias("kind"), n.alias("norm"), w.alias("written"))
    words = F.split(F.regexp_replace(m, TITLED, ""), " ")
    frame = mentions.withColumns({"d": digits, "country": country, "words": words}).withColumn("gender", gender)
    parts = F.when(kind == "name", F.transform("words", of_name)).otherwise(F.array(entry(kind, norm, m)))
    return frame.select("mention", F.posexplode(parts).alias("place", "part")).select("mention", "place", "part.*")


def rendered() -> Column:
    """`surrogate` in the format of `written`."""
    ordinal = "1 + length(regexp_replace(substring(written, 1, i), '[^0-9A-Za-z]', ''))"
    formatted = f"""array_join(transform(split(written, ''), (c, i) -> case when c rlike '[0-9A-Za-z]'
        then substring(regexp_replace(surrogate, '[^0-9A-Za-z]', ''), {ordinal}, 1) else c end), '')"""
    # the leading zero of a national number is no part of it
    trunk = "if(kind = 'phone' and written like '0%', concat('0', substring(made, 2)), made)"
    groups = "array_join(transform(sequence(0, 7), i -> substring(surrogate, 1 + 4 * i, 4)), ':')"
    numbers = F.expr(f"transform(array({formatted}), made -> {trunk})[0]")
    upper = F.col("written") == F.upper("written")
    capitals = F.when(upper, F.upper("surrogate"))
    # a name's two halves, where it is written with a hyphen
    halves = "concat(initcap(substring(surrogate, 1, 4)), '-', initcap(substring(surrogate, 5)))"
    name = F.when(F.contains("written", F.lit("-")), F.expr(halves)).otherwise(F.initcap("surrogate"))
    name = F.when(upper, F.upper(name)).otherwise(name)
    before = F.regexp_extract("written", r"^\p{Lu}['’](?=\p{Lu})", 0)
    return (
        F.when(F.col("kind").isin("phone", "ssn", "card", "iban"), numbers)
        .when(F.col("kind") == "ip", F.col("surrogate"))
        .when(F.col("kind") == "ip6", F.when(F.lower("written") == F.col("written"), F.expr(groups)).otherwise(F.upper(F.expr(groups))))
        .when(F.col("kind") == "email", capitals.otherwise(F.col("surrogate")))
        .when(F.col("kind") == "initial", F.col("written"))
        .otherwise(F.concat(before, name))
    )


def replacements(mentions: DataFrame, key: str) -> DataFrame:
    """(mention, new, kind, surnames) for distinct mentions; `surnames` are those in a name, as
    written and as they become."""
    parts = stored(parts_of(mentions))
    initials = parts.where("kind = 'initial'").select("kind", "norm", F.col("norm").alias("surrogate"))
    table = stored(assign(parts.where("kind <> 'initial'").select("kind", "norm").distinct(), key).union(initials.distinct()))
    written = parts.join(table, ["kind", "norm"]).select("mention", "place", "kind", "written", rendered().alias("new"))
    pieces = F.array_sort(F.collect_list(F.struct("place", "new", "kind", "written"))).alias("pieces")
    title = F.regexp_extract("mention", TITLED, 0)
    whole = F.array_join(F.col("pieces.new"), " ")
    named = F.element_at("pieces", -1)["kind"].startswith("surname")
    surnames = F.filter("pieces", lambda x: x["kind"].startswith("surname"))
    return (
        written.groupBy("mention")
        .agg(pieces)
        .select(
            "mention",
            F.when(named, F.concat(title, whole)).otherwise(whole).alias("new"),
            F.when(named, F.lit("name")).otherwise(F.element_at("pieces", -1)["kind"]).alias("kind"),
            F.transform(surnames, lambda x: F.struct(x["written"].alias("written"), x["new"].alias("new"))).alias("surnames"),
        )
    )


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """`docs` with surrogates in `text`, and `n_entities` and `kinds` (of its mentions, in order).

    Surnames that stand alone in a text that names the person are replaced too, and not counted.
    Only texts with entities meet the table of surrogates; a hot entity's mentions are one row a
    distinct text, and adaptive execution splits them in the join."""
    kept = [c for c in docs.columns if c not in ("text", "n_entities", "kinds")]
    frame = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").alias("the text"))
    # what no entity is without, asked first as it costs less
    hint = F.contains("the text", F.lit("@")) | F.col("the text").rlike(DIGITS) | F.col("the text").rlike(PATTERNS["name"])
    marked = frame.withColumn("has any", F.coalesce(hint & F.col("the text").rlike(ANY), F.lit(False)))
    touched = marked.where("`has any`").withColumn("text key", F.xxhash64("the text"))
    mentions = F.regexp_extract_all("the text", F.lit(ANY), 0)
    hits = stored(
        touched.select(F.col("text key").alias("key"), F.explode(F.array_distinct(mentions)).alias("mention")).distinct()
    )
    table = stored(replacements(hits.select("mention").distinct(), key))
    entry = F.struct("mention", F.struct("new", "kind").alias("value"))
    # one written form has one surrogate, so names that several mentions share agree
    names = F.array_distinct(F.flatten(F.collect_list("surnames")))
    maps = hits.join(table, "mention").groupBy("key").agg(
        F.map_from_entries(F.collect_list(entry)).alias("map"), F.map_from_entries(names).alias("alone")
    )
    joined = touched.join(maps, F.col("text key") == F.col("key")).withColumns(
        {"mentions": F.transform(mentions, lambda m: F.col("map")[m]), "gaps": F.split("the text", ANY, -1)}
    )
    pattern = "'" + BARE.replace("\\", "\\\\").replace("'", "\\'") + "'"
    alone = f"""if(cardinality(alone) = 0 or g = '', g, array_join(zip_with(split(g, {pattern}, -1), regexp_extract_all(g, {pattern}, 0),
        (x, w) -> concat(x, coalesce(alone[w], w, ''))), ''))"""
    woven = f"array_join(transform(gaps, (g, i) -> concat({alone}, coalesce(get(mentions, i).new, ''))), '')"
    own = [F.col(f"`{c}`") for c in kept]
    changed = joined.select(*own, F.expr(woven).alias("text"), F.size("mentions").alias("n_entities"), F.col("mentions.kind").alias("kinds"))
    clean = marked.where("not `has any`").select(
        *own, F.col("the text").alias("text"), F.lit(0).alias("n_entities"), F.array().cast("array<string>").alias("kinds")
    )
    return clean.unionByName(changed)
