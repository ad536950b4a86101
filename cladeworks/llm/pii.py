r"""Personal data by weak supervision, with native column expressions only.

Patterns propose spans. A format, a gazetteer and a context labeler vote on each (for, against, or
abstain); each kind has its own rules, and none of them is implied by the pattern that proposed the span.
Expectation-maximisation over the table of vote combinations estimates how reliable each labeler is, how
frequent true spans of each kind are, and so how likely each combination is personal data. A logistic span
classifier is trained on those soft labels from the votes and from features of the text (length, share of
digits, variety of characters, the word before); its weights become a column expression that decides which
of the proposed spans join the base ones, which always stay.
The table has at most ``kinds x 3^3 x 3^3 x CUE_BUCKETS`` rows whatever the corpus, so it alone comes to the driver.

Base kinds follow a fixed contract: email, ip, card and phone, leftmost and not overlapping per kind,
then a check (octets at most 255, Luhn, digit counts) that drops what fails. Further kinds are
``local`` (a phone number without a plus), ``ssn``, ``mail`` (a written-out address), ``name`` (a
capitalised name after a title, or a known first name and a capitalised word) and ``secret`` (a quoted
value that could be a credential). Positions are code points,
the end exclusive.

Defined results: null and empty texts have no spans; repeated rows get equal results; whole texts are
scanned whatever their length; an empty table gives an empty result; helper columns start with ``_pi_``, and
``redact`` takes columns of any name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.columns import apart
from cladeworks.runtime import materialize, read_table

#: Base kinds, as listed in the contract. Patterns start only where a leftmost match can start, and are
#: possessive, so that none takes quadratic time or recursion on long runs.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Gazetteers, fixed values: first names, words that make a capitalised pair a place or body, endings of domains.
FIRST_NAMES = (
    "Adam Ahmed Alan Albert Alejandro Alexander Ali Alice Amanda Amy Ana Andrea Andrew Angela Ann Anna Anne Anthony Antonio Barbara Benjamin Brian Carlos Carmen Carol Caroline Catherine Charles Charlotte Chen "
    "Chloe Chris Christian Christine Christopher Claire Daniel David Deborah Diana Diego Dmitri Donald Dorothy Edward Elena Elizabeth Emily Emma Eric Fatima Felix Fernando Francesca Francisco Frank Gabriel George Giovanni Grace "
    "Hannah Hans Harold Heather Helen Henry Ibrahim Igor Irene Isabel Ivan Jack Jacob James Jane Jason Javier Jean Jennifer Jessica Joan John Jonathan Jorge Jose Joseph Joshua Juan Julia Julie Karen Karl "
    "Katherine Kevin Klaus Laura Lars Lena Leonard Linda Lisa Louis Lucas Lucia Luis Luke Magnus Margaret Maria Marie Mark Marta Martin Mary Matthew Michael Michelle Miguel Mohammed Nancy Natalia Nicholas Nicole "
    "Olga Oliver Olivia Patricia Patrick Paul Pedro Peter Philip Pierre Rachel Rebecca Richard Robert Ronald Rosa Ruth Ryan Samuel Sandra Sarah Simon Sofia Sophie Stephanie Stephen Steven Susan Teresa Thomas Timothy "
    "Ursula Victor Victoria Virginia Walter Wei William Yuki"
).split()
PLACES = "Airport Avenue Bay Beach Bridge Castle Cathedral Church City College County Court Day Falls Foundation Hall High Hospital House Institute Island Lake Lane Museum Park Prize River Road School Society Square Station Street Theatre Tower University Valley".split()
DOMAINS = "ac app at au be biz br ca ch cn co com cz de dev dk edu es eu fi fr gov gr hu ie in info int io it jp kr me mil mx net nl no nz org pl pt ro ru se sg tr uk us za".split()
#: Proposed kinds.
TITLES = "Mr|Ms|Mrs|Dr|Prof|Herr|Frau|Mme|Sr|Sra"
EXTRA = {
    "local": r"(?<![0-9+(.-])(?<![0-9+]\x20)\(?[2-9][0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "mail": r"(?i)(?<![a-z0-9._-])[a-z0-9._-]{2,}+\x20?[\[(]\x20?at\x20?[\])]\x20?[a-z0-9-]++(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?[a-z0-9-]++)++",
    "name": rf"(?<![A-Za-z])(?=[A-Z])(?:(?<=\b(?:{TITLES})\.?\x20)[A-Z][a-z]++(?:\x20[A-Z][a-z]++)?|(?:{'|'.join(FIRST_NAMES)})\x20[A-Z][a-z]++)(?![A-Za-z])",
    "secret": r"(?<=[=:]\x20?[\"'])[A-Za-z0-9_+/=-]{16,}+(?=[\"'])",
}
#: Characters of which a text must hold one for a kind's pattern to be tried.
NEEDED = {"email": "@", "phone": "+", "mail": "[(", "ip": ".", "ssn": "-", "secret": "=:"}
KINDS = [*BASE, *EXTRA]
#: Words that, just before a span, speak for its kind.
_PHONES = "call|phone|tel|telephone|mobile|cell|fax|contact|whatsapp|telefon|llamar|appel"
_MAILS = "e-?mail|mail|contact|reach|write|to|kontakt|correo"
CUES = {
    "email": _MAILS, "ip": "ip|host|address|addr|server|client|login", "card": "card|visa|mastercard|amex|iban|account|payment", "phone": _PHONES, "local": _PHONES,
    "ssn": "ssn|security|social|taxpayer", "mail": _MAILS, "name": f"{TITLES}|name|regards|sincerely|author|patient|contact", "secret": "token|password|passwd|pwd|secret|api_?key|access_?key|auth|bearer|credential",
}
#: Words that speak against every kind, and those against one.
DENY = "version|release|section|chapter|figure|isbn|issn|doi|order|invoice|no|nr|page|sku|serial|ticket|model|build|lot"
DENY_KIND = {"secret": "href|src|class|style|id|rel|type|alt|title|sha1|sha256|md5|checksum|digest|hash|integrity|uuid|etag"}
#: Characters before a span that the context labeler sees.
CONTEXT = 32
#: Hash buckets of the word before a span; bucket 0 is for none.
CUE_BUCKETS = 32
#: Positions summed at a time; keeps prefix sums linear on texts with very many matches.
BLOCK = 256


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("int"), lambda a, b: a + b)


def _starts(lengths: Column, blocks: Column) -> Column:
    """Start of each match from the distances between starts and the totals of earlier blocks."""
    return F.transform(lengths, lambda _, i: F.get(blocks, F.floor(i / BLOCK).cast("int")) + _total(F.slice(lengths, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK + 1)))


def _luhn(text: Column) -> Column:
    digits = F.reverse(F.split(F.translate(text, " -", ""), ""))
    return F.aggregate(F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(text, r"\."), lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return _luhn(text)
    if kind == "phone":
        return F.length(F.regexp_replace(text, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _ends_in(before: Column, words: str) -> Column:
    return before.rlike(rf"(?i)(?<![A-Za-z0-9])(?:{words})[^A-Za-z0-9]{{0,4}}$")


def _votes(kind: str, hit: Column, before: Column) -> tuple[Column, Column, Column]:
    """1 for, 0 abstain, -1 against; in the order format, gazetteer, context."""
    digits = F.length(F.regexp_replace(hit, "[^0-9]", ""))
    shape = {
        "email": F.when(hit.rlike(r"(?i)\.[a-z]{2,12}$"), 1).otherwise(-1),
        "ip": F.when(hit.rlike(r"(?:^|\.)0[0-9]"), -1).otherwise(1),
        "card": F.when(digits.isin(15, 16), 1).otherwise(0),
        "phone": F.when(digits.between(10, 13), 1).otherwise(0),
        "local": F.when(hit.rlike(r"^\(?[2-9][0-9]{2}\)?[\x20.-][2-9]"), 1).otherwise(-1),
        "ssn": F.when(hit.rlike(r"^(?:000|666|9)|-00-|-0000$"), -1).otherwise(1),
        "mail": F.when(hit.rlike(r"(?i)[a-z].*at.*[\])]\x20?[a-z]{2,12}$"), 1).otherwise(-1),
        "name": F.when(hit.rlike("^[A-Z][a-z]+\x20[A-Z][a-z]+$"), 1).otherwise(0),
        "secret": F.when(hit.rlike("[0-9]") & hit.rlike("[A-Za-z]"), 1).otherwise(-1),
    }[kind]
    domain = F.when(hit.rlike(rf"(?i)[^a-z](?:{'|'.join(DOMAINS)})$"), 1).otherwise(-1)
    listed = {
        "email": domain,
        "ip": F.when(hit.rlike(r"^(?:127\.|0\.|255\.)"), -1).otherwise(0),
        "card": F.when(hit.rlike("^[3-6]"), 1).otherwise(-1),
        "phone": F.when(hit.rlike(r"^\+[1-9]"), 1).otherwise(-1),
        # Toll-free and service numbers, numbers kept for fiction; numbers that were published as examples.
        "local": F.when(hit.rlike(r"^\(?(?:8(?:00|33|44|55|66|77|88)|900|[2-9]11)|[\x20.-]555[\x20.-]01"), -1).otherwise(0),
        "ssn": F.when(hit.isin("078-05-1120", "219-09-9999"), -1).otherwise(0),
        "mail": domain,
        "name": F.when(hit.rlike(rf"\x20(?:{'|'.join(PLACES)})$"), -1).when(hit.rlike(rf"^(?:{'|'.join(FIRST_NAMES)})\b"), 1).otherwise(0),
        "secret": F.when(hit.rlike("(?i)example|placeholder|changeme|your|xxxx|dummy"), -1).when(hit.rlike("^(?:sk-|gh[pos]_|AKIA|xox[abp]-|eyJ|AIza)"), 1).otherwise(0),
    }[kind]
    against = f"{DENY}|{DENY_KIND[kind]}" if kind in DENY_KIND else DENY
    context = F.when(_ends_in(before, against), -1).when(_ends_in(before, CUES[kind]), 1).otherwise(0)
    return shape, listed, context


def _features(hit: Column, before: Column) -> list[Column]:
    """Classes of the text that the classifier sees beside the votes."""
    size, digits = F.length(hit), F.length(F.regexp_replace(hit, "[^0-9]", ""))
    variety = F.size(F.array_distinct(F.split(hit, "")))
    word = F.lower(F.regexp_extract(before, "([A-Za-z]+)[^A-Za-z0-9]{0,4}$", 1))
    cue = F.when(word == "", 0).otherwise(F.crc32(word) % (CUE_BUCKETS - 1) + 1).cast("int")
    return [
        F.when(size < 12, 0).when(size < 20, 1).otherwise(2).alias("size"), F.when(digits == 0, 0).when(digits * 2 < size, 1).otherwise(2).alias("digits"),
        F.when(variety < 5, 0).when(variety < 11, 1).otherwise(2).alias("variety"), cue.alias("cue"),
    ]


def _holds(characters: str) -> Column:
    return reduce(Column.__or__, [F.contains("_pi_text", F.lit(c)) for c in characters])


def proposed_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_pi_spans``: kind number, start, end, the three votes and the classes of ``_features``."""
    df = docs.withColumn("_pi_text", F.coalesce(F.col(text_col), F.lit("")))
    none = F.array().cast("array<string>")
    hits = {k: F.regexp_extract_all("_pi_text", F.lit(p), F.lit(0)) for k, p in (BASE | EXTRA).items()}
    df = df.withColumns({f"_pi_hit_{k}": F.when(_holds(NEEDED[k]), h).otherwise(none) if k in NEEDED else h for k, h in hits.items()})
    df = df.withColumns({f"_pi_gap_{k}": F.when(F.size(f"_pi_hit_{k}") > 0, F.split("_pi_text", p, -1)).otherwise(none) for k, p in (BASE | EXTRA).items()})

    def lengths(kind: str) -> Column:
        return F.transform(F.col(f"_pi_hit_{kind}"), lambda _, i: F.length(F.get(f"_pi_gap_{kind}", i)) + F.coalesce(F.length(F.get(f"_pi_hit_{kind}", i - 1)), F.lit(0)))

    def blocks(kind: str) -> Column:
        every = F.sequence(F.lit(0), F.floor((F.size(f"_pi_len_{kind}") - 1) / BLOCK).cast("int"))
        totals = F.transform(every, lambda b: _total(F.slice(f"_pi_len_{kind}", b * BLOCK + 1, BLOCK)))
        return F.when(F.size(f"_pi_len_{kind}") > 0, totals).otherwise(F.array().cast("array<int>"))

    def ahead(kind: str) -> Column:
        return F.transform(F.col(f"_pi_blk_{kind}"), lambda _, b: _total(F.slice(f"_pi_blk_{kind}", 1, b)))

    df = df.withColumns({f"_pi_len_{k}": lengths(k) for k in KINDS})
    df = df.withColumns({f"_pi_blk_{k}": blocks(k) for k in KINDS})
    df = df.withColumns({f"_pi_sum_{k}": ahead(k) for k in KINDS})
    df = df.withColumns({f"_pi_at_{k}": _starts(F.col(f"_pi_len_{k}"), F.col(f"_pi_sum_{k}")) for k in KINDS})

    def spans(kind: str) -> Column:
        valid = F.filter(F.arrays_zip(F.col(f"_pi_at_{kind}").alias("at"), F.col(f"_pi_hit_{kind}").alias("hit"), F.col(f"_pi_gap_{kind}").alias("gap")), lambda x: x["hit"].isNotNull() & _valid(kind, x["hit"]))

        def span(x: Column) -> Column:
            before = F.right(x["gap"], F.lit(CONTEXT))
            shape, listed, context = _votes(kind, x["hit"], before)
            end = x["at"] + F.length(x["hit"])
            return F.struct(x["at"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), shape.alias("shape"), listed.alias("listed"), context.alias("context"), *_features(x["hit"], before))

        return F.transform(valid, span)

    df = df.withColumn("_pi_spans", F.array_sort(F.concat(*[spans(k) for k in KINDS])))
    return df.select(*docs.columns, "_pi_spans")


#: What the classifier sees of a span: fields, the number of values of each, and what is added so that they count from 0.
FIELDS = {"kind": (len(KINDS), 0), "shape": (3, 1), "listed": (3, 1), "context": (3, 1), "size": (3, 0), "digits": (3, 0), "variety": (3, 0), "cue": (CUE_BUCKETS, 0)}


#: Chances of a vote against, an abstention and a vote for, of true and of other spans, before any data: rules that speak
#: against a span are seldom wrong. In the estimate these, and even odds, count ``WRITTEN`` times as much as a kind's spans, so that
#: kinds without contradicting votes do not drift to one class; that also fixes which class is which.
VOTES_OF_TRUE, VOTES_OF_OTHER, WRITTEN = (0.01, 0.39, 0.6), (0.6, 0.3, 0.1), 2.0


@dataclass(frozen=True)
class SpanModel:
    """What is learned of each kind: how frequent true spans are, the chances of each labeler's votes by latent class, and the classifier's weights, as lists by kind and value."""

    prior: list[float]
    reliability: list[list[list[list[float]]]]
    weights: dict[str, list[list[float]]]

    def score(self, span: tuple[int, ...]) -> float:
        return sum(self.weights[f][span[0]][v + up] for (f, (_, up)), v in zip(FIELDS.items(), span, strict=True))

    def accepts(self, span: Column) -> Column:
        at = lambda f, n, up: F.element_at(F.array(*[F.lit(w) for row in self.weights[f] for w in row]), span["kind"] * n + span[f] + up + 1)
        return sum((at(f, n, up) for f, (n, up) in FIELDS.items()), F.lit(0.0)) > 0


def train(table: list[tuple[tuple[int, ...], int]], rounds: int = 50, steps: int = 400, rate: float = 0.5, ridge: float = 0.002) -> SpanModel:
    """From ``((value of each of FIELDS), count)`` to a model; each kind is fitted by itself, however many spans it has."""
    rows = np.array([r for r, _ in table], dtype=int).reshape(-1, len(FIELDS)) + [up for _, up in FIELDS.values()]
    n = np.array([c for _, c in table], dtype=float)
    kind, votes, kinds = rows[:, 0], rows[:, 1:4], len(KINDS)
    of_kind = np.bincount(kind, n, kinds)
    written = np.array([VOTES_OF_TRUE, VOTES_OF_OTHER])
    held = np.maximum(2.0, WRITTEN * of_kind)
    prior, rel = np.full(kinds, 0.5), np.tile(written[:, None, None, :], (1, kinds, 3, 1))  # class, kind, labeler, vote
    soft = np.zeros(len(rows))
    for _ in range(rounds):
        chance = [np.prod([rel[z, kind, i, votes[:, i]] for i in range(3)], axis=0) for z in (0, 1)]
        soft = prior[kind] * chance[0] / (prior[kind] * chance[0] + (1 - prior[kind]) * chance[1])
        prior = (np.bincount(kind, n * soft, kinds) + held / 2) / (of_kind + held)
        for z, mass in enumerate((n * soft, n * (1 - soft))):
            for i in range(3):
                seen = np.bincount(kind * 3 + votes[:, i], mass, kinds * 3).reshape(kinds, 3) + held[:, None] * written[z]
                rel[z, :, i] = seen / seen.sum(axis=1, keepdims=True)
    sizes = [size for size, _ in FIELDS.values()]
    at = kind[:, None] * sizes + rows + np.cumsum([0, *[kinds * size for size in sizes[:-1]]])
    share, weights = n / of_kind[kind], np.zeros(kinds * sum(sizes))
    for _ in range(steps):
        miss = share * (1 / (1 + np.exp(-weights[at].sum(axis=1))) - soft)
        weights = weights - rate * (ridge * weights + np.bincount(at.ravel(), np.repeat(miss, len(FIELDS)), len(weights)))
    parts = np.split(weights, np.cumsum([kinds * size for size in sizes])[:-1])
    return SpanModel(prior.tolist(), rel.tolist(), {f: w.reshape(kinds, -1).tolist() for f, w in zip(FIELDS, parts, strict=True)})


def fit(spans: DataFrame) -> SpanModel:
    """Counts of combinations of votes and classes over every span of the corpus; then EM and the classifier."""
    each = spans.select(F.explode("_pi_spans").alias("s")).groupBy(*[f"s.{f}" for f in FIELDS]).count()
    return train(sorted((tuple(r[:-1]), r[-1]) for r in each.collect()))


def accepted_spans(spans: DataFrame, model: SpanModel) -> DataFrame:
    """``_pi_spans`` reduced to the base kinds and to what the classifier accepts."""
    return spans.withColumn("_pi_spans", F.filter("_pi_spans", lambda s: (s["kind"] < len(BASE)) | model.accepts(s)))


def _label(s: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with each accepted span replaced by ``[KIND]``; where spans overlap, the first starts the cut."""
    return apart(docs, _redacted, text_col=text_col, chars_col=chars_col)


def _redacted(docs: DataFrame, text_col: str, chars_col: str) -> DataFrame:
    proposed = materialize(proposed_spans(docs, text_col))  # with the texts, so that patterns run once
    found = accepted_spans(proposed, fit(proposed))
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.coalesce(F.col(text_col), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.element_at(tags, s["kind"] + 1))
        parts = F.when(s["start"] >= acc["at"], F.concat(acc["parts"], F.array(piece))).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

    rest = lambda acc: F.concat(F.array_join(acc["parts"], ""), text.substr(acc["at"] + 1, F.length(text)))
    clean = F.when(F.size("_pi_spans") > 0, F.aggregate("_pi_spans", start, step, rest)).otherwise(F.col(text_col))
    out = found.withColumn(text_col, clean)
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.size("_pi_spans") > 0, F.length(text_col).cast("long")).otherwise(F.col(chars_col)))
    return out.select(*docs.columns)


def op1_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    proposed = materialize(proposed_spans(docs).select("doc_id", "_pi_spans"))
    found = accepted_spans(proposed, fit(proposed))
    count = lambda kind: F.size(F.filter("_pi_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    base = F.array_join(F.transform(F.filter("_pi_spans", lambda s: s["kind"] < len(BASE)), _label), ",")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(base, 256).alias("base_sha256"), F.array_join(F.transform("_pi_spans", _label), ",").alias("spans"))
