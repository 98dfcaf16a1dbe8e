"""Surrogates for personal data, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adlumen.llm.common import fresh, sql_text, stored

#: Titles that tell a name and its gender.
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "господин", "г-н"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Signora", "госпожа", "г-жа"]
NEUTRAL = ["Dr", "Prof", "доктор"]
#: Syllables and endings of made-up names, and the letters of other scripts.
SYLLABLES = ["ba", "de", "fi", "go", "lu", "ma", "ne", "ri", "so", "tu", "va", "ze", "ka", "mi", "ro", "la"]
ENDINGS = {"given-m": "n", "given-f": "na", "given": "l", "family": "rd"}
LATIN, CYRILLIC, GREEK = "abdefgiklmnorstuvz", "абдефгиклмнорстувз", "αβδεφγικλμνορστυωζ"

_TITLES = "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
_WORD = r"\p{Lu}[\p{L}'’-]{1,40}"
_BOUND, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_NAMED = r"(?i:token|secret|api[_-]?key|password|passwd|pwd)"
#: What counts as personal data or a secret, in order of preference at one place.
PARTS = [
    r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",       # mail address
    rf"(?<={_NAMED}[\"']{{0,1}} {{0,2}}[=:] {{0,2}}[\"']{{0,1}})[^\s\"']{{6,}}",              # named secret
    rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",                            # IP address
    rf"{_BOUND}\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?\d{{2,4}}(?:[ .-]?\d{{2,4}}){{1,4}}{_END}",  # phone
    rf"(?<![\p{{L}}\p{{N}}+])\(\d{{3}}\) ?\d{{3}}-\d{{4}}{_END}",
    rf"{_BOUND}\d{{3}}-\d{{3}}-\d{{4}}{_END}",
    rf"{_BOUND}\d{{3}}-\d{{2}}-\d{{4}}{_END}",                                                 # social security
    rf"{_BOUND}(?:\d{{13,19}}|\d{{4}}(?:[ -]\d{{4}}){{3}}){_END}",                             # card
    rf"{_BOUND}[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?{_END}",        # bank account
    rf"{_BOUND}(?:[0-9a-f]{{32,128}}|[0-9A-F]{{32,128}}|AKIA[0-9A-Z]{{16}}){_END}",            # key
    rf"(?<!\p{{L}})(?:{_TITLES})\.? {_WORD}(?: (?=\p{{Lu}}\p{{L}}))?",                         # title and first word
    rf"(?<=(?<!\p{{L}})(?:{_TITLES})\.{{0,1}} {_WORD} ){_WORD}",                               # and the next
]
FOUND = "|".join(f"(?:{p})" for p in PARTS)
#: Texts without any of these hold nothing of the above (a named secret has a = or : before
#: it). One look at a letter settles most places of a text.
HINT = rf"[0-9@=:]|(?=[{''.join(sorted({t[0] for t in MALE + FEMALE + NEUTRAL}))}])(?:{_TITLES})\.? \p{{Lu}}"
#: Rounds after which a crowded set of surrogates is reported as an error.
ROUNDS = 60


def _kind(e: str) -> str:
    title = "(?:" + "|".join(sorted(MALE, key=len, reverse=True)) + r")\.? "
    lady = "(?:" + "|".join(sorted(FEMALE, key=len, reverse=True)) + r")\.? "
    any_ = f"(?:{_TITLES})" + r"\.? "
    q = sql_text
    return f"""CASE
      WHEN {e} RLIKE '{q(r"^[^@\s]+@[^@\s]+[.][^@\s]+$")}' THEN 'mail'
      WHEN {e} RLIKE '{q(r"^[0-9]{1,3}([.][0-9]{1,3}){3}$")}' THEN 'ip'
      WHEN {e} RLIKE '{q(r"^[+(]?[0-9][0-9 ().-]*$")}' THEN 'number'
      WHEN {e} RLIKE '{q("^" + title)}.* $' THEN 'given-m'
      WHEN {e} RLIKE '{q("^" + lady)}.* $' THEN 'given-f'
      WHEN {e} RLIKE '{q("^" + any_)}.* $' THEN 'given'
      WHEN {e} RLIKE '{q("^" + any_)}' OR {e} RLIKE '{q("^" + _WORD + "$")}' THEN 'family'
      WHEN {e} RLIKE '^([0-9a-f]+|[0-9A-F]+)$' THEN 'hex'
      ELSE 'secret' END"""


_LEAD = sql_text(rf"^(?:{_TITLES})\.? ")


def _canonical(kind: str, e: str) -> str:
    """The form that all spellings of one entity share."""
    return f"""CASE WHEN {kind} = 'number' THEN regexp_replace({e}, '[^0-9]', '')
      WHEN {kind} IN ('mail', 'hex') THEN lower({e})
      WHEN {kind} IN ('given-m', 'given-f', 'given', 'family') THEN lower(trim(regexp_replace({e}, '{_LEAD}', '')))
      ELSE {e} END"""


def _number(at: int, most: int) -> str:
    return f"CAST(conv(substr(d, {at}, 4), 16, 10) AS INT) % {most}"


def _candidate() -> str:
    """A surrogate from the keyed digest ``d``; longer with more attempts where the form allows."""
    digit, letter = "translate(d, 'abcdef', '012345')", "translate(d, '0123456789', 'ghijklmnop')"

    def spelled(x: str) -> str:
        return f"""array_join(transform(split({x}, ''), (c, i) -> CASE WHEN c RLIKE '^[0-9]$' THEN substr({digit}, i % 64 + 1, 1)
          WHEN c RLIKE '{sql_text(r"^[\p{Lu}]$")}' THEN upper(substr({letter}, i % 64 + 1, 1))
          WHEN c RLIKE '{sql_text(r"^[\p{L}]$")}' THEN substr({letter}, i % 64 + 1, 1) ELSE c END), '')"""

    syllables = "array(" + ", ".join(f"'{s}'" for s in SYLLABLES) + ")"
    stem = (f"array_join(transform(sequence(0, 2 + attempt DIV 4), i -> element_at({syllables}, "
            "CAST(conv(substr(d, 60 - i % 50, 1), 16, 10) AS INT) + 1)), '')")
    ending = "CASE kind " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ENDINGS.items()) + " END"
    name = f"concat({stem}, {ending})"
    script = f"""CASE WHEN canonical RLIKE '{sql_text(r"\p{IsCyrillic}")}' THEN translate({name}, '{LATIN}', '{CYRILLIC}')
      WHEN canonical RLIKE '{sql_text(r"\p{IsGreek}")}' THEN translate({name}, '{LATIN}', '{GREEK}') ELSE {name} END"""
    more = f"substr({letter}, 1, attempt DIV 4)"
    return f"""CASE
      WHEN kind = 'number' THEN concat(substr(canonical, 1, 1), substr({digit}, 1, length(canonical) - 1))
      WHEN kind = 'ip' THEN concat_ws('.', 1 + {_number(1, 223)}, {_number(5, 256)}, {_number(9, 256)}, 1 + {_number(13, 254)})
      WHEN kind = 'mail' THEN concat({spelled("substring_index(canonical, '@', 1)")}, {more}, '@',
        translate(substr(sha2(concat(secret, '|domain|', substring_index(canonical, '@', -1)), 256), 1, 10), '0123456789', 'ghijklmnop'), '.example')
      WHEN kind = 'hex' THEN substr(repeat(d, length(canonical) DIV 64 + 1), 1, length(canonical))
      WHEN kind = 'secret' THEN concat({spelled("canonical")}, {more})
      ELSE {script} END"""


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate), distinct within a kind and never one of the originals.

    ``found``: (kind, canonical), no row twice. Candidates are digests with ``key``. Of
    entities with one candidate the first keeps it; it and every surrogate settled so far
    are then taken, and so is every original. The rest tries again with another digest.
    """
    found = stored(found, "entities")
    settled, open_ = None, found
    for attempt in range(ROUNDS):
        tried = (open_.select("kind", "canonical", F.lit(key).alias("secret"), F.lit(attempt).alias("attempt"))
                 .withColumn("d", F.sha2(F.concat_ws("|", "secret", "kind", "attempt", "canonical"), 256))
                 .selectExpr("kind", "canonical", f"{_candidate()} AS surrogate"))
        tried = stored(tried, "candidates")
        first = tried.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        free = first.join(found.select("kind", F.col("canonical").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled, ["kind", "surrogate"], "left_anti")
        free = free.select("kind", "canonical", "surrogate")
        settled = stored(free if settled is None else settled.union(free), "surrogates")
        open_ = stored(found.join(settled, ["kind", "canonical"], "left_anti"), "entities-open")
        if open_.isEmpty():
            return settled
    raise ValueError("too few surrogates of one form")


def _rendered() -> str:
    """The surrogate in the spelling of the entity ``e``."""
    return f"""CASE
      WHEN kind = 'number' THEN array_join(transform(split(e, ''), (c, i) -> CASE WHEN c RLIKE '^[0-9]$'
        THEN substr(surrogate, length(regexp_replace(substr(e, 1, i + 1), '[^0-9]', '')), 1) ELSE c END), '')
      WHEN kind IN ('given-m', 'given-f', 'given', 'family') THEN concat(regexp_extract(e, '{_LEAD}', 0),
        CASE WHEN regexp_replace(e, '{_LEAD}', '') = upper(e) THEN upper(surrogate) ELSE initcap(surrogate) END,
        regexp_extract(e, ' $', 0))
      WHEN e = upper(e) AND e <> lower(e) THEN upper(surrogate) ELSE surrogate END"""


def pseudonymised(docs: DataFrame, into: str, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``into``: n_found, text.

    Mail and IP addresses, phone, card, account and social-security numbers, keys, named
    secrets, and names behind a title get a surrogate of their kind: equal entities the
    same one everywhere, different ones different ones. Spelling (digits' places, upper
    case), script and the gender of given names are kept.

    Null text stays null, a text without entities stays as it is. Rows with one text,
    repeated or not, are worked on once. No rows: no output. Other columns pass. An
    entity in very many texts is aggregated before the shuffle; only the join of its
    occurrences meets it often, which adaptive execution splits.
    """
    text = F.col(text_col).cast("string")
    a, b = fresh("text_hash", docs.columns), fresh("text_check", docs.columns)
    own = [F.xxhash64(text).alias("h"), F.hash(text).alias("g")]
    hits = docs.where(text.rlike(HINT)).select(*own, F.regexp_extract_all(text, F.lit(FOUND), F.lit(0)).alias("all"))
    # the outer form: for the inner one Spark adds a filter that searches all texts twice
    each = hits.select("h", "g", F.posexplode_outer("all").alias("at", "e")).where("e IS NOT NULL")
    each = stored(each.selectExpr("h", "g", "at", "e", f"{_kind('e')} AS kind")
                  .selectExpr("*", f"{_canonical('kind', 'e')} AS canonical"), "occurrences")
    table = surrogates(each.select("kind", "canonical").distinct(), key)
    new = (each.join(table, ["kind", "canonical"]).selectExpr("h", "g", "at", f"{_rendered()} AS new")
           .groupBy(F.col("h").alias(a), F.col("g").alias(b))
           .agg(F.transform(F.sort_array(F.collect_set(F.struct("at", "new"))), lambda x: x["new"]).alias(into)))
    cut = f"split(CAST(`{text_col}` AS STRING), '{sql_text(FOUND)}')"
    joined = docs.withColumns({a: F.xxhash64(text), b: F.hash(text)}).join(new, [a, b], "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.expr(
        f"""CASE WHEN {into} IS NULL THEN named_struct('n_found', 0L, 'text', CAST(`{text_col}` AS STRING))
            ELSE named_struct('n_found', CAST(size({into}) AS BIGINT), 'text',
              array_join(zip_with({cut}, {into}, (x, y) -> concat(x, coalesce(y, ''))), '')) END""").alias(into))


def report(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_found and the text with surrogates, for every row."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return pseudonymised(given, "found", key).select("doc_id", F.col("found.n_found").alias("n_found"),
                                                     F.col("found.text").alias("text"))
