"""Column expressions over bars, written once and rendered for Spark SQL or for the oracle's SQL.

Division by zero gives NULL, logarithms of non-positive values are NULL, and NULL is the only
missing value. All windows are row frames of one symbol in time order.
"""

from __future__ import annotations

ORDER = "PARTITION BY symbol ORDER BY ts"
#: Rows folded at once in a mean over a whole series.
BLOCK = 720


def frame(n: int | None, ahead: bool = False) -> str:
    if ahead:
        return f"OVER ({ORDER} ROWS BETWEEN 1 FOLLOWING AND {n} FOLLOWING)"
    start = "UNBOUNDED" if n is None else str(n - 1)
    return f"OVER ({ORDER} ROWS BETWEEN {start} PRECEDING AND CURRENT ROW)"


def over(f: str, x: str, n: int | None) -> str:
    return f"{f}({x}) {frame(n)}"


def full(n: int, e: str, x: str = "*") -> str:
    """NULL until the frame has n rows (or n values of x)."""
    return f"CASE WHEN count({x}) {frame(n)} >= {n} THEN {e} END"


def at_least(x: str, n: int, m: int, e: str) -> str:
    return f"CASE WHEN count({x}) {frame(n)} >= {m} THEN {e} END"


def lag(x: str, k: int = 1) -> str:
    return f"lag({x}, {k}) OVER ({ORDER})"


def lead(x: str, k: int = 1) -> str:
    return f"lead({x}, {k}) OVER ({ORDER})"


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def ln(x: str) -> str:
    return f"(CASE WHEN {x} > 0 THEN ln({x}) END)"


def root(x: str) -> str:
    return f"(CASE WHEN {x} >= 0 THEN sqrt({x}) END)"


def avg(x: str, n: int | None) -> str:
    return over("avg", x, n)


def std(x: str, n: int) -> str:
    return over("stddev_samp", x, n)


def zscore(x: str, n: int, m: int | None = None) -> str:
    e = div(f"{x} - {avg(x, n)}", std(x, n))
    return at_least(x, n, n if m is None else m, e)


def corr(a: str, b: str, n: int, m: int | None = None) -> str:
    """Pearson over the rows where both are there; NULL for a constant side."""
    x, y = f"CASE WHEN {b} IS NOT NULL THEN {a} END", f"CASE WHEN {a} IS NOT NULL THEN {b} END"
    e = div(over("covar_pop", f"{a}, {b}", n), f"({over('stddev_pop', x, n)} * {over('stddev_pop', y, n)})")
    return f"CASE WHEN count({x}) {frame(n)} >= {n if m is None else m} THEN {e} END"


def given(need: str | None, e: str) -> str:
    return e if need is None else f"CASE WHEN {need} THEN {e} END"


class Spark:
    name = "spark"

    def quantile(self, x: str, p: float, n: int) -> str:
        return f"percentile({x}, {p}D) {frame(n)}"

    def gather(self, x: str, n: int | None) -> str:
        return f"collect_list({x}) {frame(n)}"

    def gather_ahead(self, x: str, n: int) -> str:
        return f"collect_list({x}) {frame(n, True)}"

    def fold(self, arr: str, a: float) -> str:
        return f"aggregate({arr}, 0D, (s, v) -> s * {1 - a!r}D + v)"

    def total(self, arr: str, v: str, e: str) -> str:
        return f"aggregate(transform({arr}, {v} -> {e}), 0D, (s, v) -> s + v)"

    def total_at(self, arr: str, e: str) -> str:
        """Sum of e(v, i), i from 0."""
        return f"aggregate(transform({arr}, (v, i) -> {e}), 0D, (s, x) -> s + x)"

    def having(self, arr: str, v: str, e: str) -> str:
        return f"filter({arr}, {v} -> {e})"

    def size(self, arr: str) -> str:
        return f"size({arr})"

    def first(self, arr: str) -> str:
        return f"try_element_at({arr}, 1)"

    def record(self, **fields: str) -> str:
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"

    def pair_where(self, need: str, a: str, b: str) -> str:
        return f"CASE WHEN {need} IS NOT NULL THEN array({a}, {b}) END"

    def folded(self, arr: str) -> str:
        """Exponential mean over pairs (value, weight kept of the mean before)."""
        return f"element_at(aggregate({arr}, try_element_at({arr}, 1), (s, e) -> array(s[0] * e[1] + (1 - e[1]) * e[0], 0D)), 1)"

    def weekday(self, ts: str) -> str:
        return f"weekday({ts})"

    def last_known(self, x: str, n: int | None = None) -> str:
        return f"last({x}, true) {frame(n)}"


    def means(self, wanted: dict[str, tuple[str, float, str | None]], cast: bool = True) -> list[dict[str, str]]:
        """Unadjusted exponential means {name: (column, a, condition or None)} over the whole series, as layers.

        A series is cut into blocks of BLOCK rows: Z of a row is that of its block so far, and
        what the blocks before carry over, each decayed by the values that followed."""
        columns = list(dict.fromkeys(c for c, *_ in wanted.values()))
        tag = "_".join(columns)
        block = f"blk_{tag}"
        inside = f"OVER (PARTITION BY symbol, {block} ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        earlier = f"OVER ({ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        arrays = {f"arr_{c}": f"collect_list(CAST({c} AS DOUBLE)) {inside}" for c in columns}
        arrays |= {f"fst_{c}": f"first(CAST({c} AS DOUBLE), true) {frame(None)}" for c in columns} | {f"cnt_{c}": f"count({c}) {frame(None)}" for c in columns}
        arrays |= {f"end_{tag}": f"coalesce(lead({block}) OVER ({ORDER}) <> {block}, false)"}
        sums = {f"z_{k}": self.fold(f"arr_{c}", a) for k, (c, a, _) in wanted.items()}
        ends = {f"past_{k}": f"collect_list(CASE WHEN end_{tag} THEN {self.record(z=f'z_{k}', n=f'size(arr_{c})')} END) {earlier}" for k, (c, *_) in wanted.items()}
        out = {}
        for k, (c, a, need) in wanted.items():
            carried = f"aggregate(past_{k}, 0D, (s, b) -> s * power({1 - a!r}D, b.n) + b.z)"
            z = f"(z_{k} + power({1 - a!r}D, size(arr_{c})) * {carried})"
            out[k] = given(need, f"(CASE WHEN cnt_{c} > 0 THEN {z} * {a!r}D + power({1 - a!r}D, cnt_{c}) * fst_{c} END)")
        return [{block: f"floor((row_number() OVER ({ORDER}) - 1) / {BLOCK})"}, arrays, sums, ends, out]

    def seen(self, x: str) -> str:
        """How many values the mean of a series stands on."""
        return over("count", x, None)


class Duck(Spark):
    name = "duckdb"

    def means(self, wanted: dict[str, tuple[str, float, str | None]], cast: bool = True) -> list[dict[str, str]]:
        """The oracle's frames hold BLOCK rows, which is the whole series of the test tables; longer ones differ."""
        arrays = {f"arr_{c}": self.gather(f"CAST({c} AS DOUBLE)" if cast else c, BLOCK) for c, *_ in wanted.values()}
        return [arrays, {k: given(need, ewm(self, f"arr_{c}", a, False)) for k, (c, a, need) in wanted.items()}]

    def seen(self, x: str) -> str:
        return over("count", x, BLOCK)

    def quantile(self, x: str, p: float, n: int) -> str:
        return f"quantile_cont({x}, {p}) {frame(n)}"

    def gather(self, x: str, n: int | None) -> str:
        return f"list({x}) FILTER (WHERE {x} IS NOT NULL) {frame(n)}"

    def gather_ahead(self, x: str, n: int) -> str:
        return f"list({x}) {frame(n, True)}"

    def fold(self, arr: str, a: float) -> str:
        return f"list_reduce(list_prepend(0::DOUBLE, {arr}), lambda s, v: s * {1 - a!r} + v)"

    def total(self, arr: str, v: str, e: str) -> str:
        return f"coalesce(list_sum(list_transform({arr}, lambda {v}: {e})), 0)"

    def total_at(self, arr: str, e: str) -> str:
        return f"coalesce(list_sum(list_transform(list_zip({arr}, range(len({arr}))), lambda z: {self._zip(e)})), 0)"

    @staticmethod
    def _zip(e: str) -> str:
        import re

        return re.sub(r"\bi\b", "z[2]", re.sub(r"\bv\b", "z[1]", e))

    def having(self, arr: str, v: str, e: str) -> str:
        return f"list_filter({arr}, lambda {v}: {e})"

    def size(self, arr: str) -> str:
        return f"len({arr})"

    def first(self, arr: str) -> str:
        return f"{arr}[1]"

    def record(self, **fields: str) -> str:
        return "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"

    def pair_where(self, need: str, a: str, b: str) -> str:
        return f"CASE WHEN {need} IS NOT NULL THEN [{a}, {b}] END"

    def folded(self, arr: str) -> str:
        return f"list_reduce({arr}, lambda s, e: [s[1] * e[2] + (1 - e[2]) * e[1], 0::DOUBLE])[1]"

    def weekday(self, ts: str) -> str:
        return f"(isodow({ts}) - 1)"

    def last_known(self, x: str, n: int | None = None) -> str:
        return f"last_value({x} IGNORE NULLS) {frame(n)}"


def ewm(d: Spark, arr: str, a: float, adjust: bool) -> str:
    """Exponential mean over an array (oldest first) from its weighted sum Z = sum (1-a)^age x."""
    z, n = d.fold(arr, a), d.size(arr)
    if adjust:
        return f"(CASE WHEN {n} > 0 THEN {z} * {a!r} / (1 - power({1 - a!r}, {n})) END)"
    return f"(CASE WHEN {n} > 0 THEN {z} * {a!r} + power({1 - a!r}, {n}) * {d.first(arr)} END)"


def kept_weight(steps: str, a: float) -> str:
    """Weight that an unadjusted mean keeps when the next value comes ``steps`` rows later."""
    w = f"power({1 - a!r}, coalesce({steps}, 1))"
    return f"CAST({w} / ({w} + {a!r}) AS DOUBLE)"


def span(n: int) -> float:
    return 2 / (n + 1)
