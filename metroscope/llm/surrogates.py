"""Personal data surrogates, with DataFrame and SQL functions only.

Detection finds e-mail addresses, phone numbers, payment cards (Luhn-valid), social
security numbers, IPv4 addresses, hexadecimal secrets and names (after a title or a
listed given name). Phones are 3-3-4 digits with or without a country code, or ``+`` and 8
to 15 digits in any groups; names without a title or a listed given name are not found, nor
are national numbers of another form. Every distinct entity of the corpus gets one keyed replacement of its
own type: digits stay digits in the same places and grouping, a card stays Luhn-valid
and keeps its first digit, an address stays an address, a name keeps its gender (after a
title of either gender that of a listed given name, else male), script and capitals. The
written forms of one entity (``706-555-3138``, ``+1 706-555-3138`` and ``+1 (706) 555-3138``; ``Mr. Smith`` and ``John Smith``'s surname) share a replacement, so
coreference holds over the whole corpus.

Collision check: a replacement that two entities drew, or that is itself a real entity of
the corpus, is kept by at most one of them; the others draw again with the next attempt
number. Addresses and names grow by a letter or syllable with each attempt, so their space
never fills. Numbers keep their format; where a format's space is so densely used that
entities are still open after ``ROUNDS`` attempts, all entities of that format are handed round
among themselves in a keyed order instead: each gets another one's number, so replacements stay
distinct and of their type, though no longer unlike every real entity (there is no room for
that). The entity table is corpus-wide and grows with the input; it is only ever joined and
grouped, never collected.

The tables that link real and replaced data exist only until the result is written:
``settled_private`` writes it and deletes them. The key is the caller's secret.

Numbers that stand beside one another (a card and its check value, two phones, a date and
a card) are told apart: everything with a form of its own ends a run of digit groups, and
inside a run every Luhn-valid stretch of whole groups is a card.

Defined results: null and empty texts stay; a card-like number that fails Luhn, an address
with a part over 255 and a name without title or listed given name stay; repeated rows
are changed alike; without entities the rows come back unchanged.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from metroscope.llm.common import drop_written, free_name, written

ROUNDS = 6              # attempts before a dense number format is handed round
MAX_ATTEMPTS = 40       # attempts of the growing types
ROTATION_ROWS = 1000    # about so many entities are handed round together
# Number types, and what of a number its replacement keeps besides the length.
FORMATS = {"ip": "''", "ssn": "length(norm)", "secret": "length(norm)", "card": "concat(length(norm), '-', substr(norm, 1, 1))",
           "phone": "if(length(norm) = 10, '10', concat(length(norm), '-', substr(norm, 1, 1)))"}

# Titles that give a gender, and the given names that start a name (and are
# the first choice as replacements), by script and gender.
TITLES_M = ("Mr", "Herr", "Monsieur", "Señor", "Г-н", "Господин")
TITLES_F = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Г-жа", "Госпожа")
TITLES = ("Dr", "Prof", "Professor", "Doktor", "Docteur", "Д-р", "Доктор", "Проф", "Профессор")  # of either gender
NAMES = {
    ("latin", "m"): ("James", "John", "Robert", "Michael", "William", "David", "Thomas", "Daniel", "Peter", "Hans",
                     "Jürgen", "Pierre", "François", "Carlos", "José", "Miguel"),
    ("latin", "f"): ("Mary", "Patricia", "Linda", "Elizabeth", "Barbara", "Susan", "Sarah", "Anna", "Ursula", "Monika",
                     "Marie", "Françoise", "Carmen", "María", "Lucía", "Isabel"),
    ("cyrillic", "m"): ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай"),
    ("cyrillic", "f"): ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна"),
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe fi ka ke ki ko la le li lo ma me mi mo na ne no ra re ri sa ta to".split(),
    "cyrillic": "ба бе би бо да де ди до ва ве ви ка ке ки ко ла ле ли ло ма ме ми мо на не но ра ре ри са та то".split(),
}

_EDGE = r"(?<![\p{L}\p{N}])"
_CAP = r"\p{Lu}[\p{L}'’-]{1,40}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Every repetition is bounded (64 characters before the @, as addresses are): hostile texts
# cost linear time, and the engine's recursion over repeated groups stays shallow.
EMAIL = r"[\p{L}0-9._%+-]{1,64}+@(?:[\p{L}0-9-]{1,63}\.){1,9}\p{L}{2,24}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])"
IPV4 = rf"(?<![0-9]\.){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])"
# A phone is 3-3-4 digits, with or without a country code, or + and 8 to 15 digits whose
# groups stand apart by one separator or brackets; what starts another number is no group.
_LOCAL = r"[0-9]{3}(?:\)[ .-]?|[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
_CODED = rf"\+[0-9]{{1,3}}[ .-]?\(?{_LOCAL}"
_OTHER = rf"{_LOCAL}|{SSN}|{IPV4}|{EMAIL}|[0-9]{{4}}[ -](?:[0-9]{{4}}[ -][0-9]{{4}}[ -][0-9]{{4}}|[0-9]{{6}}[ -][0-9]{{4}})"
_ABROAD = rf"\+[0-9](?:(?:(?:[ .-]?\(|\)[ .-]?|[ .-])(?!{_OTHER}))?[0-9]){{7,14}}(?![0-9])"
PHONE = rf"{_CODED}|{_ABROAD}|\(?{_LOCAL}"
SECRET = r"(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\p{L}\p{N}])"
# Digit groups with single separators, as far as they go: the cards are looked for inside.
# A group that starts something else, or is longer than a card, ends the run.
RUN = rf"(?![0-9]{{20}})(?=[0-9](?:[ -]?[0-9]){{12}})[0-9]++(?:[ -](?![0-9]{{20}}|{EMAIL}|{IPV4}|{SSN}|{SECRET}|{PHONE})[0-9]++)*+"
# Usual groupings of a card; they go before any other cut of a run.
CARD_FORM = "[0-9]{13,19}|[0-9]{4}(?:-[0-9]{4}){3}(?:-[0-9]{1,3})?|[0-9]{4}-[0-9]{6}-[0-9]{4,5}"
_GIVEN = "|".join(n for names in NAMES.values() for n in names)
_TITLES = rf"(?:(?:{'|'.join(TITLES_M + TITLES_F + TITLES)})[.]? ){{1,3}}+"
TITLE = f"^({_TITLES})"
NAME = rf"{_TITLES}{_CAP}(?: {_CAP})?|(?:{_GIVEN}) {_CAP}"
PATTERN = (rf"(?:{_EDGE}(?:{EMAIL}|{IPV4}|{SSN}|{SECRET})|(?<![\p{{L}}\p{{N}}])(?:{_CODED}|{_ABROAD})|(?<![\p{{L}}\p{{N}}+])\(?{_LOCAL}"
           rf"|{_EDGE}(?:{RUN}|{NAME}))")


def _sql(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _luhn_sum(digits: str, shift: int) -> str:
    """SQL: Luhn sum of a digit string; ``shift`` 0 doubles the last digit, 1 the one before."""
    d = f"cast(substr({digits}, i, 1) as int)"
    return (f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + if((length({digits}) - i) % 2 = {shift}, "
            f"{d} * 2 - if({d} > 4, 9, 0), {d}))")


def _digits(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '')"


def _kind() -> Column:
    """Type of a mention; null where a look-alike fails its check."""
    m, whole = F.col("mention"), lambda p: f"^(?:{p})$"
    return (
        F.when(m.rlike(whole(EMAIL)), "email").when(m.rlike(whole(IPV4)), "ip").when(m.rlike(whole(SSN)), "ssn")
        .when(m.rlike(whole(PHONE)), "phone")
        .when(m.rlike(whole(SECRET)), "secret").when(m.rlike(whole(RUN)), "card").when(m.rlike(whole(NAME)), "name")
    )


def _cards() -> Column:
    """The cards of a run from left to right, as (``lead``, ``word``, ``tail``) whose texts
    give the run again: Luhn-valid stretches of whole groups with 13 to 19 digits, those of
    a card's usual form first, then the longest that leave these alone. Empty without one."""
    def let(name: str, value: str, body: str) -> str:
        return f"transform(array({value}), {name} -> {body})[0]"

    stretches = (  # from group i, shortest first
        "filter(transform(sequence(1, least(19, size(g) - i + 1)), k -> named_struct('k', k, 'd', array_join(slice(g, i, k), ''))), "
        f"c -> length(c.d) between 13 and 19 and {_luhn_sum('c.d', 1)} % 10 = 0)")
    usual = f"filter(cs, c -> array_join(slice(g, i, c.k), '-') rlike '^(?:{CARD_FORM})$')"
    starts = ("transform(sequence(1, size(g)), i -> "
              + let("cs", stretches, f"named_struct('a', coalesce(get({usual}, 0).k, 0), 'b', transform(cs, c -> c.k))") + ")")
    other = "coalesce(array_max(filter(s[i - 1].b, k -> not exists(slice(s, i, k), x -> x.a > 0))), 0)"
    lengths = f"transform(sequence(1, size(g)), i -> if(s[i - 1].a > 0, s[i - 1].a, {other}))"
    taken = ("aggregate(sequence(1, size(g)), named_struct('e', 1, 'o', cast(array() as array<struct<i:int,e:int>>)), (t, i) -> "
             "if(i >= t.e and n[i - 1] > 0, named_struct('e', i + n[i - 1], 'o', "
             "concat(t.o, array(named_struct('i', i, 'e', i + n[i - 1])))), t)).o")
    text = lambda a, b: f"array_join(slice(gs, {a}, {b} - {a}), '')"
    cut = (f"transform(o, (x, j) -> named_struct('lead', {text('if(j = 0, 1, o[j - 1].e)', 'x.i')}, "
           f"'word', rtrim(' -', {text('x.i', 'x.e')}), 'tail', concat(regexp_extract(gs[x.e - 2], '[ -]$', 0), "
           f"if(j = size(o) - 1, {text('x.e', '(size(gs) + 1)')}, ''))))")
    return F.expr(let("gs", "regexp_extract_all(mention, '[0-9]+[ -]?', 0)", let(
        "g", "transform(gs, x -> rtrim(' -', x))", let("s", starts, let("n", lengths, let("o", taken, cut))))))


def parts(mentions: DataFrame) -> DataFrame:
    """Column ``mention`` -> one row per entity in it: ``mention``, ``kind``, ``part`` (place),
    ``type`` (of the entity), ``norm`` (its one normal form), ``word`` (its text) and the
    texts round it, ``lead`` and ``tail``."""
    typed = mentions.withColumn("kind", _kind()).filter("kind is not null")
    either, gendered = "|".join(TITLES), "|".join(TITLES_M + TITLES_F)
    title = f"regexp_extract(mention, {_sql(f'^(?:(?:{either})[.]? )*({gendered})[.]? ')}, 1)"
    cyr = r"mention rlike '\\p{IsCyrillic}'"
    has = lambda names: f"array_contains(array({', '.join(map(_sql, names))}), %s)"
    men = [n for (_, g), names in NAMES.items() if g == "m" for n in names]
    women = [n for (_, g), names in NAMES.items() if g == "f" for n in names]
    first = "element_at(words, 1)"
    gender = (f"case when {has(TITLES_M) % title} or ({title} = '' and {has(men) % first}) then 'm' "
              f"when {has(TITLES_F) % title} or {has(women) % first} then 'f' else 'm' end")
    words = f"split(regexp_replace(mention, {_sql(TITLE)}, ''), ' ')"
    none = F.lit("")
    single = typed.filter("kind not in ('name', 'card')").select(
        "mention", "kind", F.lit(0).alias("part"), F.col("kind").alias("type"),
        F.expr(f"case when kind in ('email', 'secret') then lower(mention) when kind = 'ip' then mention "
               f"when kind = 'phone' then regexp_replace({_digits('mention')}, if(mention like '+1%', '^1(?=[0-9]{{10}}$)', '^$'), '') "
               f"else {_digits('mention')} end").alias("norm"), none.alias("lead"), F.col("mention").alias("word"), none.alias("tail"))
    cards = typed.filter("kind = 'card'").select("mention", "kind", F.posexplode(_cards()).alias("part", "c")).select(
        "mention", "kind", "part", F.col("kind").alias("type"), F.expr(_digits("c.word")).alias("norm"), "c.lead", "c.word", "c.tail")
    names = typed.filter("kind = 'name'").withColumn("words", F.expr(words)).withColumn("g", F.expr(gender)).select(
        "mention", "kind", "g", "words", F.regexp_extract("mention", TITLE, 1).alias("title"),
        F.posexplode("words").alias("part", "word"))
    script = f"if({cyr}, 'cyrillic', 'latin')"
    return single.unionByName(cards).unionByName(names.select(
        "mention", "kind", "part",
        F.expr(f"concat(if(part = size(words) - 1, 'surname', concat('given-', g)), '-', {script})").alias("type"),
        F.lower("word").alias("norm"), F.expr("if(part = 0, title, '')").alias("lead"), "word",
        F.expr("if(part < size(words) - 1, ' ', '')").alias("tail")))


def _draw(key: str) -> Column:
    """The keyed replacement of (``type``, ``norm``) for ``attempt``, in normal form."""
    def seed(tail: str) -> str:
        return f"sha2(concat_ws('|', {_sql(key)}, type, norm, cast(attempt as string), {tail}), 256)"

    letters = "'abcdefghijklmnopqrstuvwxyz'"
    byte = lambda h, i: f"cast(conv(substr({h}, 1 + (2 * ({i})) % 126, 2), 16, 10) as int)"
    hexes, digs = "h", "translate(h, 'abcdef', '012345')"

    def swapped(text: str, h: str) -> str:
        ch = f"substr({text}, i, 1)"
        return (f"array_join(transform(sequence(1, length({text})), i -> case when {ch} rlike '[0-9]' then "
                f"substr('0123456789', 1 + {byte(h, 'i')} % 10, 1) when {ch} rlike '\\\\p{{IsCyrillic}}' then "
                f"substr('абвгдежзиклмнопрстуфхцчшщэюя', 1 + {byte(h, 'i')} % 28, 1) when {ch} rlike '\\\\p{{L}}' then "
                f"substr({letters}, 1 + {byte(h, 'i')} % 26, 1) else {ch} end), '')")

    local, domain = "substring_index(norm, '@', 1)", "regexp_replace(substring_index(norm, '@', -1), '[.][^.]*$', '')"
    host = f"sha2(concat_ws('|', {_sql(key)}, 'domain', substring_index(norm, '@', -1)), 256)"
    host = f"concat({host}, {host})"
    longer = (f"if(attempt = 0, '', array_join(transform(sequence(1, greatest(attempt, 1)), i -> "
              f"substr({letters}, 1 + {byte(hexes, '40 + i')} % 26, 1)), ''))")
    email = f"concat({swapped(local, hexes)}, {longer}, '@', {swapped(domain, host)}, '.', substring_index(norm, '.', -1))"
    lead = f"translate(substr({digs}, 1, 1), '01', '27')"
    area = (f"if(length(norm) = 10, concat({lead}, substr({digs}, 2, 9)), "
            f"concat(substr(norm, 1, 1), {lead}, substr({digs}, 2, length(norm) - 2)))")
    body = f"concat(substr(norm, 1, 1), substr({digs}, 1, length(norm) - 2))"
    check = f"cast((10 - {_luhn_sum(body, 0)} % 10) % 10 as string)"
    octets = ", ".join([f"1 + {byte(hexes, 1)} % 223", *[byte(hexes, i) for i in (2, 3, 4)]])

    def syllables(script: str, n: str) -> str:
        arr = f"array({', '.join(map(_sql, SYLLABLES[script]))})"
        return f"array_join(transform(sequence(1, {n}), i -> element_at({arr}, 1 + {byte(hexes, 'i')} % 32)), '')"

    cases = []
    for (script, g), names in NAMES.items():
        arr = f"array({', '.join(_sql(n.lower()) for n in names)})"
        end = {"latin": {"m": "n", "f": "a"}, "cyrillic": {"m": "н", "f": "а"}}[script][g]
        cases.append(f"when type = 'given-{g}-{script}' then if(attempt < 2, element_at({arr}, 1 + {byte(hexes, 0)} % "
                     f"{len(names)}), concat({syllables(script, 'attempt')}, '{end}'))")
    for script in SYLLABLES:
        cases.append(f"when type = 'surname-{script}' then {syllables(script, '3 + attempt')}")
    return F.expr(
        f"case when type = 'email' then {email} when type = 'ip' then concat_ws('.', {octets}) "
        f"when type = 'phone' then {area} when type = 'card' then concat({body}, {check}) "
        f"when type = 'ssn' then substr({digs}, 1, length(norm)) when type = 'secret' then substr(h, 1, length(norm)) "
        f"{' '.join(cases)} end".replace("(h, ", "(h, ")), F.expr(f"concat({seed(_sql('a'))}, {seed(_sql('b'))})")


def _format() -> Column:
    return F.expr("case " + " ".join(f"when type = '{t}' then concat('{t}-', {e})" for t, e in FORMATS.items()) + " end")


def _handed_round(entities: DataFrame, key: str) -> DataFrame:
    """``type``, ``norm``, ``format`` -> ``surrogate``: the next entity of the same format in keyed
    order, in rings of about ``ROTATION_ROWS``."""
    place = F.sha2(F.concat_ws("|", F.lit(key), F.lit("ring"), "type", "norm"), 256)
    sized = entities.join(entities.groupBy("format").agg(F.count(F.lit(1)).alias("size")), "format").withColumn("place", place)
    rings = F.greatest(F.lit(1), F.floor(F.col("size") / ROTATION_ROWS))
    ring = Window.partitionBy("format", "ring")
    following = F.coalesce(F.lead("norm").over(ring.orderBy("place", "norm")), F.first("norm").over(ring.orderBy("place", "norm")))
    return sized.withColumn("ring", F.pmod(F.xxhash64("place"), rings)).select("type", "norm", following.alias("surrogate"))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``type``, ``norm`` (distinct) -> plus ``surrogate``: distinct within a type and never the
    normal form of any real entity of that type, except in number formats without room for it
    (see the module's text), where no entity gets its own."""
    draw, seed = _draw(key)
    real = entities.select("type", F.col("norm").alias("surrogate"))
    done: DataFrame | None = None
    open_ = entities
    for attempt in range(MAX_ATTEMPTS):
        drawn = open_.withColumn("attempt", F.lit(attempt)).withColumn("h", seed).select("type", "norm", draw.alias("surrogate"))
        first = F.row_number().over(Window.partitionBy("type", "surrogate").orderBy("norm")) == 1
        good = drawn.withColumn("first", first).filter("first").drop("first").join(real, ["type", "surrogate"], "left_anti")
        if done is not None:
            good = good.join(done.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        good = written(good.select("type", "norm", "surrogate"), "private-drawn")
        done = good if done is None else done.unionByName(good)
        left = written(open_.join(good, ["type", "norm"], "left_anti").select("type", "norm"), "private-open")
        if attempt:
            drop_written(open_)
        open_ = left
        if attempt == ROUNDS - 1:
            dense = open_.select(_format().alias("format")).filter("format is not null").distinct()
            if not dense.isEmpty():
                within = entities.withColumn("format", _format()).join(dense, "format", "left_semi")
                rest = done.withColumn("format", _format()).join(dense, "format", "left_anti").drop("format")
                settled = written(rest.unionByName(_handed_round(within, key)), "private-drawn")
                drop_written(done)
                done, open_ = settled, open_.filter(_format().isNull())
        if open_.isEmpty():
            drop_written(left)
            return done
    raise RuntimeError(f"entities without a distinct replacement after {MAX_ATTEMPTS} attempts")


def _reformat() -> Column:
    """The replacement in the written form of the mention (digit places, capitals)."""
    ch = "substr(word, i, 1)"
    nth = "length(regexp_replace(substr(word, 1, i), '[^0-9]', ''))"
    in_places = (f"array_join(transform(sequence(1, length(word)), i -> if({ch} rlike '[0-9]', "
                 f"substr(surrogate, {nth}, 1), {ch})), '')")
    coded = f"type = 'phone' and length({_digits('word')}) > length(surrogate)"  # +1 stays before the ten digits
    return F.expr(
        f"case when {coded} then {in_places.replace('substr(surrogate,', "substr(concat('1', surrogate),")} when type in ('phone', 'card', 'ssn') then {in_places} when type = 'ip' then surrogate "
        "when word = upper(word) and word != lower(word) then upper(surrogate) "
        "when type like 'given%' or type like 'surname%' then initcap(surrogate) else surrogate end")


def mapping(mentions: DataFrame, key: str) -> DataFrame:
    """Distinct ``mention`` -> ``surrogate`` text and the number ``n`` of replaced entities, a
    name counting once (look-alikes are left out). A written table; what it was made from is
    deleted."""
    p = written(parts(mentions), "private-parts")
    table = assign(p.select("type", "norm").distinct(), key)
    new = F.struct("part", F.concat("lead", _reformat(), "tail").alias("new"))
    out = written(p.join(table, ["type", "norm"]).groupBy("mention").agg(
        F.first("kind").alias("kind"), F.array_sort(F.collect_list(new)).alias("news")
    ).select("mention", F.array_join(F.transform("news", lambda x: x["new"]), "").alias("surrogate"),
             F.when(F.col("kind") == "name", 1).otherwise(F.size("news")).alias("n")), "private-map")
    drop_written(p)
    drop_written(table)
    return out


def settled_private(docs: DataFrame, key: str, **options) -> DataFrame:
    """``replace_private``, written; every table that holds real data beside its replacement is
    deleted before this returns."""
    rows = replace_private(docs, key, **options)
    out = written(rows, "surrogate-rows")
    drop_written(rows, "/private-")
    return out


def replace_private(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text",
                    count_col: str | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with the private data of ``text_col`` replaced;
    ``count_col`` names an added column with the number of replaced mentions. The rows read
    two written tables of real data (``settled_private`` deletes them after use)."""
    if not key:
        raise ValueError("a secret key is needed")
    found = written(
        docs.select(F.col(id_col).alias("k_id"), F.xxhash64(F.col(text_col)).alias("k_hash"),
                    F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(PATTERN), F.lit(0))).alias("mentions"))
        .filter(F.size("mentions") > 0), "private-found")
    # one row per different document and mention; repeated rows share it
    per_doc = found.select("k_id", "k_hash", F.explode("mentions").alias("mention")).distinct()
    table = mapping(per_doc.select("mention").distinct(), key)
    renamed = per_doc.join(table, "mention").groupBy("k_id", "k_hash").agg(
        F.map_from_entries(F.collect_list(F.struct("mention", F.struct("surrogate", "n")))).alias("renames"))
    names = {c: free_name(docs, c) for c in ("k_id", "k_hash", "renames")}
    renamed = renamed.select(*[F.col(c).alias(n) for c, n in names.items()])
    text, new = F.col(text_col), F.col(names["renames"])
    joined = docs.join(renamed, F.col(id_col).eqNullSafe(F.col(names["k_id"]))
                       & (F.xxhash64(text) == F.col(names["k_hash"])), "left")
    said = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    swapped = F.transform(said, lambda m: F.coalesce(new[m]["surrogate"], m))
    rebuilt = F.array_join(F.zip_with(F.split(text, PATTERN), swapped, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    out = [F.when(new.isNull(), text).otherwise(rebuilt).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if count_col:
        n = F.when(new.isNull(), F.lit(0)).otherwise(F.aggregate(said, F.lit(0), lambda n, m: n + F.coalesce(new[m]["n"], F.lit(0))))
        out.append(n.cast("long").alias(count_col))
    return joined.select(*out)
