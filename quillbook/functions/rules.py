"""Attributes derived from a source prefix, an account and free text fields.

An attribute is an ordered list of rules. A rule names the source prefixes and
account conditions under which it applies and the text it takes; the first
rule that applies wins, also when the text it takes is null.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SOURCE_CODE = "gl_full_source_code"
ACCOUNT = "orig_gl_account"
D1 = "orig_gl_description_1"
D2 = "orig_gl_description_2"
D3 = "orig_gl_description_3"
DOCUMENT = "orig_gl_source_document_id"
PROJECT = "orig_gl_project_code"
CENTER = "orig_gl_center"


@dataclass(frozen=True)
class Take:
    """A field, a trimmed or plain slice of it, or a literal."""

    field: str | None = None
    start: int = 0
    length: int = 0
    trimmed: bool = True
    literal: str | None = None

    def column(self) -> Column:
        if self.literal is not None:
            return F.lit(self.literal)
        value = F.col(self.field)
        if not self.length:
            return value
        value = F.right(value, F.lit(self.length)) if self.start < 0 else F.substring(value, self.start, self.length)
        return F.trim(value) if self.trimmed else value


def head(name: str, length: int, trimmed: bool = True) -> Take:
    return Take(name, 1, length, trimmed)


def part(name: str, start: int, length: int) -> Take:
    return Take(name, start, length)


def tail(name: str, length: int) -> Take:
    return Take(name, -1, length, trimmed=False)


@dataclass(frozen=True)
class Rule:
    prefixes: str  # space separated, three characters each
    take: str | Take
    starts: str = ""  # account starts with one of these
    starts_not: str = ""
    account: str = ""  # account is one of these
    account_not: str = ""
    has: dict[str, str] = field(default_factory=dict)  # field -> text it contains
    has_not: dict[str, str] = field(default_factory=dict)
    first_two: dict[str, str] = field(default_factory=dict)  # field -> what its first two characters may be

    def applies(self) -> Column:
        account = F.col(ACCOUNT)

        def starts_with(c: Column, options: str) -> Column:
            return reduce(lambda a, b: a | b, [c.startswith(o) for o in options.split()])

        tests = [F.substring(F.col(SOURCE_CODE), 1, 3).isin(*self.prefixes.split())]
        if self.starts:
            tests.append(starts_with(account, self.starts))
        if self.starts_not:
            tests.append(~starts_with(account, self.starts_not))
        if self.account:
            tests.append(account.isin(*self.account.split()))
        if self.account_not:
            tests.append(~account.isin(*self.account_not.split()))
        tests += [F.contains(F.col(n), F.lit(text)) for n, text in self.has.items()]
        tests += [~F.contains(F.col(n), F.lit(text)) for n, text in self.has_not.items()]
        tests += [F.substring(F.col(n), 1, 2).isin(*options.split()) for n, options in self.first_two.items()]
        return reduce(lambda a, b: a & b, tests)

    def value(self) -> Column:
        return F.col(self.take) if isinstance(self.take, str) else self.take.column()


# Which text of a ledger line holds which attribute.
ATTRIBUTES: dict[str, list[Rule]] = {
    "contractnumber": [
        Rule("545", head(D1, 10, trimmed=False)),
        Rule("038", head(D1, 10), starts="1", account_not="2872400"),
        Rule("863 864", head(D1, 12)),
        Rule("HIP", head(D1, 15), starts="2"),
        Rule("049", head(D1, 28)),
        Rule("A4V", part(D1, 6, 10), starts="VOID"),
        Rule("041", D1),
        Rule("062 122 123", D1, account_not="2861600"),
        Rule("165 147 430", D1, starts="2"),
        Rule("043", D1, starts="2", account_not="2871100 2890200 2891900 2898000"),
        Rule("043", D2, account="2898000"),
        Rule("075", D1, account="2891900"),
        Rule("074", D3, has={D1: "OTCKC"}),
        Rule("296 456 464 851 959", D1),
        Rule("143", D2, starts_not="19 99"),
        Rule("069", D2, first_two={D2: "TA N"}),
        Rule("057", D1, starts="4 6 7 829 2"),
        Rule("057", D1, starts="1"),
        Rule("145", D1, starts="19 28", account_not="2893600"),
        Rule("145", D2, starts="4 7"),
        Rule("145", D2, account="2893600"),
    ],
    "groupcontractnumber": [
        Rule("146", head(D1, 13), account="10A1200"),
        Rule("146", DOCUMENT, account="2873600"),
        Rule("143", DOCUMENT, starts="19 28"),
    ],
    "activitywithholdingtaxjurisdiction": [
        Rule("051 052 122 123", D1, account="2861600"),
        Rule("549", part(D1, 29, 2), starts="2"),
        Rule("452 453 454 458 460 462 463", part(D1, 29, 2), starts="1"),
        Rule("143", part(D1, 29, 2), starts="1"),
        Rule("863", part(D1, 13, 2), starts="2"),
    ],
    "sourceagentidentifier": [
        Rule("141", D2, account="1117300"),
        Rule("141", D1, account="1120300 1120500 2870500 2801800"),
        Rule("146", D1, account="1120300"),
        Rule("038", head(D1, 10), account="2872400"),
        Rule("073", D2, account="2871300 2888900"),
        Rule("145", D1, account="2861600"),
        Rule("039", D2, has={D1: "DTCCK"}),
        Rule("039", D3),
        Rule("668", D1, has_not={D1: "NSCCK"}),
        Rule("057", D1, starts="5 825 826 849 1120400 2871100"),
        Rule("077", D3),
    ],
    "activitydepositsourcebatchidentifier": [
        Rule("051", D2, account_not="2861600"),
        Rule("146", part(D1, 14, 17), account="10A1200"),
        Rule("146", D1, account="1004100 1090900 1090600"),
        Rule("146", D2, account="2890400 1120300 1997000 1910000 2870500 2878180 2891900"),
        Rule("146", tail(DOCUMENT, 8), starts="4111 4121"),
        Rule("146", DOCUMENT, starts="7"),
        Rule("402", D1, account="10A1200 2871300"),
        Rule("402", D2, account="2893700"),
        Rule("057", D1, account="1110900 1806200 2872600 2872700 2886500 2890100 2898000"),
        Rule("043", D1, account="1110900 2898000"),
        Rule("043", D2, starts="10 28"),
        Rule("038", D1, starts="1"),
        Rule("038", D2),
        Rule("075 109", D2),
        Rule("545", part(D1, 16, 15)),
    ],
    "checknumber": [
        Rule("017", D2, has_not={D1: "DTCCK"}),
        Rule("039 049 863 864", D2),
        Rule("456 464", D3),
    ],
    "activitysourceclaimidentifier": [
        Rule("HIP", part(D1, 16, 15), starts="2"),
    ],
    "activitysourceoriginatinguserid": [
        Rule("038", part(D1, 11, 20), starts_not="1"),
        Rule("141", D2, starts="7"),
        Rule("141", PROJECT),
        Rule("545", part(D1, 11, 5)),
    ],
    "contractsourcesystemname": [],
    "reinsurancecounterpartytype": [
        Rule("903 851 444", Take(literal="External")),
    ],
    "sourcesystemreinsurancecounterpartycode": [
        Rule("903 851 444", CENTER),
    ],
    "statutoryresidentstatecode": [],
}


def derive(rules: list[Rule]) -> Column:
    """The value of the first rule that applies, null if none does."""
    if not rules:
        return F.lit(None).cast("string")
    chain = F.when(rules[0].applies(), rules[0].value())
    for rule in rules[1:]:
        chain = chain.when(rule.applies(), rule.value())
    return chain


#: Source prefixes whose contracts come from other companies, and how these are named; a site passes its own names.
EXTERNAL = {"903": "External A", "851 444": "External B"}


def derived_attributes(
    attributes: dict[str, list[Rule]] | None = None, external: dict[str, str] | None = None
) -> dict[str, Column]:
    attributes = dict(ATTRIBUTES if attributes is None else attributes)
    names = EXTERNAL if external is None else external
    if "contractsourcesystemname" in attributes:
        attributes["contractsourcesystemname"] = [Rule(p, Take(literal=n)) for p, n in names.items()]
    return {name: derive(rules) for name, rules in attributes.items()}
