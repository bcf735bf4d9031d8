"""Decoding of coded cells as column expressions: tokens, values, verdicts.

``decode`` works in stages, each a projection of its own whose columns the next one uses several times, so that
the optimiser leaves them apart: token arrays, parsed numbers, one state a part, and values and verdicts from the
states. A cell is so split once, however many parts and verdicts its family has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmill.plans.rules import CRN_FAMILIES, EQD_FLAGS, EQD_MONTHLY, FLAG_ONLY, QUALITY, TABLES, Part, Span, allowed_quality, implied_width, is_eqd, resolve

#: States of a part. UNFIT: no value, without a verdict of its own; FLAGGED: kept though outside its domain.
GOOD, MALFORMED, BAD, MISSING, BEYOND, UNFIT, FLAGGED = range(7)
REASONS = {MALFORMED: "MALFORMED_TOKEN", BAD: "BAD_QUALITY_CODE", MISSING: "SENTINEL_MISSING", BEYOND: "OUT_OF_RANGE"}
NUMBER = r"^\+?[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def prepare(spark: SparkSession) -> None:
    """Where the session hasn't said otherwise: generated methods too long for the JVM's compiler (8,000 bytes) aren't used.

    Decoding many parts makes such methods, which would run interpreted, about three times slower.
    """
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def raw_tokens(cell: Column) -> Column:
    return F.split(cell, ",", -1)


def token(cell: Column, n: int) -> Column:
    """The trimmed n-th token; null beyond the last."""
    return F.trim(F.try_element_at(raw_tokens(cell), F.lit(n)))


def number(text: Column) -> Column:
    """A token as a double: one leading plus is dropped; what isn't a plain decimal gives null."""
    bare = F.trim(text)
    return F.when(bare.rlike(NUMBER), F.when(bare.startswith("+"), F.substr(bare, F.lit(2))).otherwise(bare).try_cast("double"))


def plain(text: Column) -> Column:
    """A token without dots, plus signs and leading zeros, as sentinels are compared."""
    bare = F.translate(text, ".+", "")
    stripped = lambda x: F.coalesce(F.nullif(F.ltrim(x, F.lit("0")), F.lit("")), F.when(x != "", "0"), F.lit(""))
    return F.when(bare.startswith("-"), F.concat(F.lit("-"), stripped(F.substr(bare, F.lit(2))))).otherwise(stripped(bare))


def is_sentinel(text: Column, sentinels: tuple[str, ...] | None) -> Column:
    return F.translate(text, ".+", "").rlike("^9{2,}$") if sentinels is None else plain(text).isin(*sentinels)


def domain_faults(text: Column, part: Part) -> tuple[Column, Column]:
    """Whether a trimmed token isn't one of the part's values, and whether it doesn't match its pattern."""
    values, pattern = F.lit(False), F.lit(False)
    if isinstance(part.values, Span):
        bounds = text.try_cast("int").between(part.values.low, part.values.high)
        values = ~(text.rlike(rf"^\d{{{part.values.width}}}$") & F.coalesce(bounds, F.lit(False)))
    elif part.values:
        values = ~F.upper(text).isin(*part.values)
    if part.pattern:
        pattern = ~text.rlike(f"^(?:{part.pattern})$")
    return values, pattern


def check_domain(text: Column, part: Part) -> Column:
    """struct(value, domain_invalid, pattern_mismatch) of a token: the value is null where either test fails."""
    bare = F.trim(text)
    values, pattern = domain_faults(bare, part)
    return F.struct(F.when(~values & ~pattern, bare).alias("value"), values.alias("domain_invalid"), pattern.alias("pattern_mismatch"))


def _text(value: str) -> str:
    """A literal of SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _among(expression: str, values) -> str:
    return f"{expression} in ({', '.join(_text(v) if isinstance(v, str) else str(v) for v in values)})"


def _any(*conditions: str) -> str:
    """The conditions joined by OR; those that never hold are left out."""
    held = [c for c in conditions if c != "false"]
    return f"({' or '.join(held)})" if held else "false"


def _case(*branches: tuple[str, object], otherwise: object = "null") -> str:
    held = [f"when {c} then {v}" for c, v in branches if c != "false"]
    return f"case {' '.join(held)} else {otherwise} end" if held else str(otherwise)


def _real(x: float) -> str:
    return f"{float(x)!r}D"


class _Cell:
    """What the text of SQL says of a family's cell: its tokens, untrimmed and trimmed, their numbers and comparable forms.

    Whole tables have hundreds of parts. As text an expression takes one call to the JVM, as columns some hundreds.
    """

    def __init__(self, identifier: str, parts: tuple[Part, ...], strict: bool):
        self.name, self.parts, self.strict = identifier, parts, strict
        self.lone = len(parts) == 1 and parts[0].quality is not None  # a value and its quality code
        self.tokens = range(1, 1 + max(len(parts), 2 if len(parts) == 1 else 0))
        self.read = [n for n, p in enumerate(parts, 1) if p.kind == "numeric" or p.low is not None or p.high is not None]
        self.compared = [n for n, p in enumerate(parts, 1) if p.sentinels]
        self.short = not strict or identifier[:2] == "AH"  # cells may lack tokens

    def at(self, kind: str, n: int | None = None) -> str:
        return f"`_{self.name}_{kind}`" + (f".{'s' if kind == 'state' else 'k'}{n}" if n else "")

    def raw(self, n: int) -> str:
        return f"get({self.at('raw')}, {n - 1})"

    def text(self, n: int) -> str:
        return self.at("text", n)

    def _place(self, kind: str, made: dict[int, str]) -> str:
        inner = ", ".join(f"'k{n}', {x}" for n, x in made.items())
        return f"{f'named_struct({inner})' if made else 'null'} as {self.at(kind)}"

    def stages(self) -> list[list[str]]:
        """Columns of the stages before the states; each uses those before it."""
        numbers = {n: f"case when {self.text(n)} rlike {_text(NUMBER)} then try_cast(case when startswith({self.text(n)}, '+') then substr({self.text(n)}, 2) else {self.text(n)} end as double) end" for n in self.read}
        return [
            [f"split(`{self.name}`, ',', -1) as {self.at('raw')}"],
            [self._place("text", {n: f"trim({self.raw(n)})" for n in self.tokens})],
            [self._place("number", numbers), self._place("plain", {n: self._plain(n) for n in self.compared})],
            [self._states()],
        ]

    def _plain(self, n: int) -> str:
        bare = f"translate({self.text(n)}, '.+', '')"
        stripped = lambda x: f"coalesce(nullif(trim(leading '0' from {x}), ''), case when {x} <> '' then '0' end, '')"
        return f"case when startswith({bare}, '-') then concat('-', {stripped(f'substr({bare}, 2)')}) else {stripped(bare)} end"

    def _states(self) -> str:
        size = f"size({self.at('raw')})"
        whole = f"{size} = {2 if self.lone else len(self.parts)}"
        states = "".join(f", 's{n}', {self.state(n)}" for n in range(1, len(self.parts) + 1))
        return f"named_struct('whole', {f'{size} > 0' if self.short else whole}, 'arity', not ({whole}){states}) as {self.at('state')}"

    def domain_faults(self, n: int) -> tuple[str, str]:
        """Whether a token isn't one of its part's values, and whether it doesn't match its pattern."""
        part, t, values = self.parts[n - 1], self.text(n), "false"
        if isinstance(part.values, Span):
            values = f"not ({t} rlike {_text(rf'^\d{{{part.values.width}}}$')} and coalesce(try_cast({t} as int) between {part.values.low} and {part.values.high}, false))"
        elif part.values:
            values = f"not {_among(f'upper({t})', part.values)}"
        return values, f"not {t} rlike {_text(f'^(?:{part.pattern})$')}" if part.pattern else "false"

    def _wrong_width(self, n: int) -> str:
        part, raw, t, wrong = self.parts[n - 1], self.raw(n), self.text(n), []
        if part.width and part.kind == "numeric":
            wrong = [f"{raw} <> {t}", f"length(trim(leading '+-' from {t})) <> {part.width}"]
        elif part.width:
            wrong = [f"length({raw}) <> {part.width}"]
        if part.token:
            wrong.append(f"not {t} rlike {_text(f'^(?:{part.token})$')}")
        return f"coalesce({_any(*wrong)}, false)" if wrong and self.strict else "false"

    def _unknown_parameter(self, t: str) -> str:
        if self.name[0] == "N":
            known = f"length({t}) = 6 and {_among(f'substring({t}, 1, 4)', TABLES['eqd_element'])} and {_among(f'substring({t}, 5, 1)', EQD_FLAGS[0])} and {_among(f'substring({t}, 6, 1)', EQD_FLAGS[1])}"
        else:
            known = _any(_among(f"upper({t})", TABLES["eqd_legacy"]), f"upper({t}) rlike {_text(f'^{EQD_MONTHLY}$')}" if self.name[0] == "R" else "false")
        return f"{t} <> '' and not ({known})"

    def state(self, n: int) -> str:
        """The state of the n-th part."""
        part, t, value = self.parts[n - 1], self.text(n), self.at("number", n)
        q = None if part.quality is None else self.text(part.quality)
        if self.lone:
            q = f"case when {q} <> '' then {q} end"
        bad = "false" if q is None else f"coalesce(not {_among(q, allowed_quality(self.parts, part))}, false)"
        common = {p.quality for p in self.parts if p.quality}
        first_lost = "false"
        if n == 1 and part.quality is None and len(common) == 1:
            k = common.pop()
            first_lost = f"{self.text(k)} <> '' and not {_among(self.text(k), self.parts[k - 1].allowed or QUALITY)}"
        missing = f"translate({t}, '.+', '') rlike '^9{{2,}}$'" if part.sentinels is None else _among(self.at("plain", n), part.sentinels) if part.sentinels else "false"
        numeric = part.kind == "numeric"
        unread = f"({t} <> '' and {value} is null)" if numeric else "false"
        values, pattern = self.domain_faults(n)
        outside = _any(values, pattern)
        unfit = [f"not {_among(f'upper({t})', part.allowed)}"] if part.kind == "quality" and part.allowed else []
        digits = None if self.lone else implied_width(self.name, part)
        if digits:
            unfit.append(f"not {t} rlike {_text(rf'^\d{{{digits}}}$')}")
        bounds = [f"{value} {sign} {_real(bound)}" for sign, bound in (("<", part.low), (">", part.high)) if bound is not None]
        beyond = f"coalesce({_any(*bounds)}, false)" if bounds else "false"
        wrong = self._wrong_width(n)
        present = lambda c: c if missing == "false" else "false" if c == "false" else f"({c}) and not ({missing})"
        if self.lone:
            return _case((wrong, MALFORMED), (present(unread), MALFORMED), (bad, BAD), (missing, MISSING), (outside, UNFIT), (beyond, BEYOND), otherwise=GOOD)
        unfit_state = _case((beyond, BEYOND), otherwise=UNFIT) if numeric else str(UNFIT)
        outside_state = str(FLAGGED) if self.name[:2] in FLAG_ONLY else _case((unread, MALFORMED), otherwise=unfit_state)
        branches = [(bad, BAD), (present(first_lost), unfit_state), (missing, MISSING), (wrong, MALFORMED), (_any(*unfit), unfit_state), (outside, outside_state)]
        if not part.text:
            if is_eqd(self.name) and n == 3:
                branches.append((self._unknown_parameter(t), UNFIT))
            branches.append((unread, MALFORMED))
            if numeric and self.name[:2] in CRN_FAMILIES and q is not None:
                branches.append((f"{q} = '9'", MISSING))
            branches.append((beyond, BEYOND))
        return _case(*branches, otherwise=GOOD)

    def fields(self) -> str:
        """The family's struct of values, quality codes, verdicts and flags, from the states."""
        whole, made = f"{self.at('state')}.whole", []
        add = lambda name, x: made.append(f"{_text(name)}, {x}")
        for n, part in enumerate(self.parts, 1):
            s, t, name = self.at("state", n), self.text(n), _names(part, n)
            there = f"{whole} and {t} is not null" if self.short else whole
            kept = f"{there} and {_among(s, (GOOD, FLAGGED))}"
            if part.kind == "numeric":
                value = self.at("number", n) + (f" * {_real(part.scale)}" if part.scale != 1 else "")
                add(name, f"case when {kept} then {value if part.cap is None else f'least({value}, {_real(part.cap)})'} end")
                if self.lone:
                    add("quality", f"case when {whole} and {self.text(part.quality)} <> '' then {self.text(part.quality)} end")
                reason = _case(*[(f"{s} = {k}", _text(v)) for k, v in REASONS.items()])
                status = _case((f"{s} = {MISSING}", "'MISSING'"), (_among(s, (MALFORMED, BAD, BEYOND)), "'INVALID'"), otherwise="'PASS'")
                add(f"{name}_qc", f"case when {there} then named_struct('pass', not {_among(s, REASONS)}, 'status', {status}, 'reason', {reason}) end")
            else:
                add(name if part.kind == "categorical" else f"q{n}", f"case when {kept} and {t} <> '' then {t} end")
        flag = lambda name, condition: add(name, f"coalesce({whole} and {condition}, false)")
        is_ = lambda n, value: f"{self.text(n)} = {_text(value)}"
        if self.name == "WND":
            flag("direction_variable", f"{is_(1, '999')} and upper({self.text(3)}) = 'V'")
            flag("calm", f"{is_(3, '9')} and {is_(4, '0000')}")
        if self.name[:2] == "OD":
            flag("calm_direction", f"{is_(3, '999')} and {is_(4, '0000')}")
        if self.name[:2] == "OE":
            flag("calm_speed", f"{is_(3, '00000')} and {is_(4, '999')}")
        if self.name[:2] in FLAG_ONLY:
            for k, name in enumerate(("domain_invalid", "pattern_mismatch")):
                faults = [(n, self.domain_faults(n)[k]) for n in range(1, len(self.parts) + 1)]
                flag(name, _any(*[f"({self.at('state', n)} = {FLAGGED} and {f})" for n, f in faults if f != "false"]))
        if self.name[:2] == "AH":
            made.append(f"'arity_mismatch', coalesce({self.at('state')}.arity, false)")
        return f"named_struct({', '.join(made)}) as `{self.name.lower()}_`"

    def columns(self) -> list[str]:
        return [f"_{self.name}_{kind}" for kind in ("raw", "text", "number", "plain", "state")]


def _names(part: Part, n: int) -> str:
    return part.name or f"part{n}"


def decode_all(df: DataFrame, identifiers: list[str], strict: bool = True) -> DataFrame:
    """df with one struct column a family (its name in small letters and an underscore): a field for each named part, else
    ``part<n>``; verdicts of numeric parts as <part>_qc; quality codes as q<n>, or quality where the family is one value and
    its code. A cell whose tokens don't have the family's number gives null fields; AH keeps them and flags it. Without
    ``strict`` every family keeps what is there: fields of tokens that lack are null, tokens beyond the last are left out.
    """
    prepare(df.sparkSession)
    found = []
    for name in dict.fromkeys(identifiers):
        parts = resolve(name)
        if parts is None:
            raise KeyError(f"{name} is not a coded column")
        found.append(_Cell(name, parts, strict))
    df = df.drop(*[c for x in found for c in [*x.columns(), f"{x.name.lower()}_"]])
    for stage in zip(*[x.stages() for x in found], strict=True):
        df = df.selectExpr("*", *[c for columns in stage for c in columns])
    return df.selectExpr("*", *[x.fields() for x in found]).drop(*[c for x in found for c in x.columns()])


def decode(df: DataFrame, identifier: str, strict: bool = True) -> DataFrame:
    """decode_all of one family."""
    return decode_all(df, [identifier], strict)


def usability(passes: list[Column]) -> list[Column]:
    """any_usable, n_usable and usable_fraction of a row, from its verdicts' pass flags; absent cells don't pass."""
    n = sum((F.coalesce(p, F.lit(False)).cast("int") for p in passes), F.lit(0))
    return [(n > 0).alias("any_usable"), n.alias("n_usable"), (n / F.lit(len(passes))).alias("usable_fraction")]
