"""Secret scans: all rules in one automaton, one pass over a text's bytes.

The searching automaton tells at which bytes matches of which rules end.  Every rule's matches
end in a greedy run or at a fixed mark, so consecutive ends belong to one match; its beginning is
found by the rule's backward automaton, which reads no further than the rule's last match.  That
gives the leftmost, longest, non-overlapping matches of each rule.  A match shorter than its rule
asks is dropped, but the text it covers stays used.

Offsets count code points, ends are exclusive.  Null and empty texts have no spans; null ids stay
null; repeated rows are scanned each on their own; an empty table gives no rows."""

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.llm.automaton import Automaton
from devpulse.llm.common import batch, pieces, text_column, utf8


class Rule(NamedTuple):
    kind: str
    pattern: str
    fold: bool = False
    # least length, of group `group` (0: the whole match)
    least: int = 0
    group: int = 0


# fixed values: the three base kinds, in their order
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        True,
        8,
        2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# further kinds of keys with public formats
FURTHER = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", least=40),
    Rule("google", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + FURTHER
Span = tuple[int, int, int]  # start, rule, end


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.forward = Automaton([(r.pattern, r.fold) for r in rules], searching=True)
        self.backward = [
            Automaton([(r.pattern, r.fold)], searching=False, backward=True) for r in rules
        ]
        self.links = None
        self.checks = [re.compile(r.pattern.encode(), re.I if r.fold else 0) for r in rules]

    def __getstate__(self):
        return self.__dict__ | {"links": None}

    def link(self) -> None:
        if self.links is None:
            self.links = [m.linked() for m in (self.forward, *self.backward)]

    def ends(self, data: bytes) -> Iterator[tuple[int, int]]:
        """(end, rules) wherever rules match, `end` exclusive."""
        state = self.links[0][0]
        mask_at = len(state) - 1
        for at, c in enumerate(data.translate(self.forward.classes), 1):
            state = state[c]
            if state[mask_at]:
                yield at, state[mask_at]

    def start(self, rule: int, data: bytes, least: int, end: int) -> int | None:
        """The first place at or after `least` from which the rule matches up to `end`."""
        classes = self.backward[rule].classes
        state, stuck = self.links[1 + rule]
        mask_at, found = len(state) - 1, None
        for at in range(end - 1, least - 1, -1):
            state = state[classes[data[at]]]
            if state is stuck:
                break
            if state[mask_at]:
                found = at
        return found

    def scan(self, data: bytes) -> list[Span]:
        """Spans in bytes, by start and then rule."""
        self.link()
        runs: list[list[list[int]]] = [[] for _ in self.rules]
        for at, mask in self.ends(data):
            for rule, own in enumerate(runs):
                if mask >> rule & 1:
                    if own and own[-1][0] == at - 1:
                        own[-1][0] = at
                    else:
                        own.append([at])
        spans = []
        for rule, own in enumerate(runs):
            used, r = 0, self.rules[rule]
            for (end,) in own:
                start = self.start(rule, data, used, end)
                if start is None:
                    continue
                used = end
                if r.least:
                    match = self.checks[rule].fullmatch(data, start, end)
                    if len(match[r.group]) < r.least:
                        continue
                spans.append((start, rule, end))
        return sorted(spans)


@cache
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def in_code_points(data: bytes, spans: list[Span]) -> list[Span]:
    if not spans or data.isascii():
        return spans
    at, chars, places = 0, 0, {}
    for p in sorted({p for s, _, e in spans for p in (s, e)}):
        chars += len(data[at:p].decode())
        places[p], at = chars, p
    return [(places[s], r, places[e]) for s, r, e in spans]


def joined(spans: list[Span], rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{rules[r].kind}:{s}:{e}" for s, r, e in spans)


def redacted(data: bytes, spans: list[Span], rules: tuple[Rule, ...]) -> str:
    """The text with each stretch covered by spans replaced by the kind of its first span."""
    out, at = [], 0
    for start, rule, end in spans:
        if start >= at:
            out += [data[at:start], f"<{rules[rule].kind}>".encode()]
        at = max(at, end)
    return b"".join([*out, data[at:]]).decode()


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256 (of the base kinds' spans),
    spans (all, as kind:start:end by start), redacted (the text without its secrets).

    `rules` starts with the three base kinds."""
    fields = [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64())]
    fields += [("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())]
    schema = pa.schema([*fields, ("redacted", pa.string())])

    scan = scanner(rules)  # made once, sent to the workers as arrays

    def run(batches):
        for b in pieces(batches):
            rows: dict[str, list] = {n: [] for n in schema.names}
            for doc, data in zip(b["doc_id"].to_pylist(), utf8(b["text"]), strict=True):
                found = scan.scan(data)
                spans = in_code_points(data, found)
                base = [s for s in spans if s[1] < len(BASE)]
                rows["doc_id"].append(doc)
                for n, rule in enumerate(("n_assign", "n_access", "n_hex")):
                    rows[rule].append(sum(s[1] == n for s in base))
                rows["base_sha256"].append(hashlib.sha256(joined(base, rules).encode()).hexdigest())
                rows["spans"].append(joined(spans, rules))
                rows["redacted"].append(redacted(data, found, rules))
            yield batch(schema, rows)

    ddl = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, redacted string"
    return docs.select(F.col("doc_id").cast("long"), text_column().alias("text")).mapInArrow(run, ddl)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with the secrets in `text` replaced by <kind>; all columns and rows stay, and
    `n_chars`, where there is one, counts the new text.  A null text stays null."""
    fields = docs.columns

    scan = scanner(rules)  # made once, sent to the workers as arrays

    def run(batches):
        for b in pieces(batches):
            at, old = fields.index("text"), b.column(fields.index("text"))
            texts = [
                None if not ok else redacted(x, scan.scan(x), rules)
                for x, ok in zip(utf8(old), old.is_valid().to_pylist(), strict=True)
            ]
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in fields:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", counted).select(*fields)
    return out
