"""SQL of the fitted forecast models: the search as recursions over days, the decomposition as joins of neighbours."""

from __future__ import annotations

from voltspan.operators import decompose as D
from voltspan.operators import forecast as M

Ctes = dict[str, tuple[tuple[str, ...], str]]

_PARAMS = "alpha, trend, season, phi, times"
_PLACES = [f"s{i}" for i in range(7)]


def _score() -> str:
    """Corrected AIC of the better error form of a state after t days, and whether that is the relative one."""
    k = "(3 + case when phi = 1 then 2 when phi > 0 then 3 else 0 end + case when season > 0 then 7 else 0 end)"
    pay = f"(2 * {k} + 2 * {k} * ({k} + 1) / (t - {k} - 1)::double)"
    plain = f"case when not times then t * ln(greatest(sse / t, 1e-300)) + {pay} end"
    relative = f"(t * ln(greatest(rse / t, 1e-300)) + 2 * logs + {pay})"
    return f"least({plain}, {relative}) as score, coalesce({plain} > {relative}, times) as relative"


def _steps(name: str, candidates: str, start: str, days: str) -> str:
    """Every candidate (key, parameters, lim) advances a day per step, until lim days are seen."""
    offsets = ", ".join(
        f"case when times then m{i} / nullif(level0, 0) when season > 0 then m{i} - level0 else 0 end as s{i}" for i in range(7)
    )
    slope = "case when phi > 0 then slope0 else 0 end"
    turned = ", ".join(_PLACES[1:])
    return f"""select c.key, 0 as t, level0 - {slope} * 29 / 2.0::double as lvl, {slope} as slp, {offsets},
        0::double as sse, 0::double as rse, 0::double as logs, {_PARAMS}, lim from {candidates} c join {start} using (key)
        union all
        select key, t + 1, base + alpha * inner_err, phi * slp + alpha * trend * inner_err, {turned},
        s0 + (1 - alpha) * season * outer_err, sse + err * err, rse + (err / nullif(fit, 0)) * (err / nullif(fit, 0)),
        logs + ln(case when fit > 0 then fit end), {_PARAMS}, lim
        from (select *, case when times then err / nullif(s0, 0) else err end as inner_err,
                case when times then err / nullif(base, 0) else err end as outer_err
              from (select *, y - fit as err
                    from (select *, case when times then base * s0 else base + s0 end as fit
                          from (select r.*, d.y, r.lvl + r.phi * r.slp as base
                                from {name} r join {days} d on r.key = d.key and r.t = d.t where r.t < r.lim))))"""


def _kept(steps: str, most: int) -> str:
    return f"""select * from (select *, {_score()} from {steps} where t = lim) where score is not null
        qualify row_number() over (partition by key order by score, relative, {_PARAMS}) <= {most}"""


def _near(kept: str) -> str:
    """The kept points and their neighbours."""
    top = f"{M.CEILING!r}::double"
    out = [f"select key, {_PARAMS} from {kept}"]
    out += [f"select key, least(alpha * {f!r}::double, {top}), trend, season, phi, times from {kept}" for f in M.STEPS["alpha"]]
    out += [f"select key, alpha, least(trend * {f!r}::double, {top}), season, phi, times from {kept} where phi > 0" for f in M.STEPS["trend"]]
    out += [f"select key, alpha, trend, season, {M.SOFTER!r}::double, times from {kept} where phi > 0"]
    out += [f"select key, alpha, trend, least(season * {f!r}::double, {top}), phi, times from {kept} where season > 0" for f in M.STEPS["season"]]
    return " union ".join(out)


def search(pre: str, seasonal: bool) -> Ctes:
    """From ``pre``_days (key, t, y) and ``pre``_stops (key, n) to ``pre``_best (key, n, parameters, state, sigma)."""
    grid = ", ".join(f"({a!r}::double, {b!r}::double, {g!r}::double, {p!r}::double, {str(x).lower()})" for a, b, g, p, x in M.coarse_grid(seasonal))
    (first, few), (second, fewer) = ((f"least(n0, greatest({M.RUNG_DAYS}, n0 // {part}))", most) for part, most in M.RUNGS.items())
    days, stops, start = f"{pre}_days", f"{pre}_stops", f"{pre}_start"
    out: Ctes = {
        f"{pre}_grid": ((), f"select * from (values {grid}) g({_PARAMS})"),
        start: ((days,), f"""select key, avg(y) as level0,
            (avg(y) filter (t >= 14) - avg(y) filter (t < 14)) / 14 as slope0,
            {", ".join(f"avg(y) filter (t % 7 = {i}) as m{i}" for i in range(7))}
            from {days} where t < 28 group by 1"""),
        f"{pre}_size": ((stops,), f"select key, min(n) as n0, max(n) as n1 from {stops} where n >= 28 group by 1"),
        f"{pre}_c1": ((f"{pre}_size", f"{pre}_grid"), f"select key, {_PARAMS}, {first} as lim from {pre}_size, {pre}_grid"),
        f"{pre}_s1": ((f"{pre}_c1", start, days), _steps(f"{pre}_s1", f"{pre}_c1", start, days)),
        f"{pre}_k1": ((f"{pre}_s1",), _kept(f"{pre}_s1", few)),
        f"{pre}_near": ((f"{pre}_k1",), _near(f"{pre}_k1")),
        f"{pre}_c2": ((f"{pre}_near", f"{pre}_size"), f"select key, {_PARAMS}, {second} as lim from {pre}_near join {pre}_size using (key)"),
        f"{pre}_s2": ((f"{pre}_c2", start, days), _steps(f"{pre}_s2", f"{pre}_c2", start, days)),
        f"{pre}_k2": ((f"{pre}_s2",), _kept(f"{pre}_s2", fewer)),
        f"{pre}_c3": ((f"{pre}_k2", f"{pre}_size"), f"select key, {_PARAMS}, n1 as lim from {pre}_k2 join {pre}_size using (key)"),
        f"{pre}_s3": ((f"{pre}_c3", start, days), _steps(f"{pre}_s3", f"{pre}_c3", start, days)),
        f"{pre}_best": ((f"{pre}_s3", stops), f"""select *, sqrt(sse / t) as sigma from (
            select s.*, {_score()}, n from {pre}_s3 s join (select distinct key, n from {stops} where n >= 28) x on x.key = s.key and x.n = s.t)
            where score is not null qualify row_number() over (partition by key, n order by score, relative, {_PARAMS}) = 1"""),
    }
    return out


def whole_search(pre: str, seasonal: bool) -> Ctes:
    """As ``search``, but every point of the whole grid runs over all days."""
    grid = ", ".join(f"({a!r}::double, {b!r}::double, {g!r}::double, {p!r}::double, {str(x).lower()})" for a, b, g, p, x in M.whole_grid(seasonal))
    out = search(pre, seasonal)
    used = {n: out[n] for n in (f"{pre}_start", f"{pre}_size", f"{pre}_s3", f"{pre}_best")}
    return used | {
        f"{pre}_grid": ((), f"select * from (values {grid}) g({_PARAMS})"),
        f"{pre}_c3": ((f"{pre}_size", f"{pre}_grid"), f"select key, {_PARAMS}, n1 as lim from {pre}_size, {pre}_grid"),
    }


_CARRY = """alpha + alpha * trend * coalesce(list_sum([phi ** j for j in range(1, i + 1) if phi > 0]), 0)"""


def _ahead(pre: str) -> str:
    """(key, cutoff, h, y_hat, error)."""
    return f"""select key, cutoff, h, case when times then base * place else base + place end as y_hat,
        sigma * sqrt(1 + coalesce(list_sum([({_CARRY}) ** 2 for i in range(1, h)]), 0)) as error
        from (select b.*, x.cutoff, h, lvl + coalesce(list_sum([phi ** j for j in range(1, h + 1) if phi > 0]), 0) * slp as base,
                ([{", ".join(_PLACES)}])[h] as place
              from {pre}_best b join {pre}_stops x using (key, n), (select cast(x as int) as h from range(1, 8) u(x)))"""


def smoothing(pre: str, filled: str, stops: str, whole: bool = False) -> Ctes:
    """``pre``: (unique_id, cutoff, ds, y_hat, error) of AutoETS at the (unique_id, cutoff) of ``stops``."""
    return {
        f"{pre}_days": ((filled,), f"""select unique_id as key, ds, y,
            cast(row_number() over (partition by unique_id order by ds) as int) - 1 as t from {filled}"""),
        f"{pre}_stops": ((stops, f"{pre}_days"), f"""select key, cutoff, t + 1 as n
            from {stops} o join {pre}_days d on o.unique_id = d.key and o.cutoff = d.ds"""),
        **(whole_search if whole else search)(pre, True),
        pre: ((f"{pre}_best", f"{pre}_stops"), f"select key as unique_id, cutoff, cutoff + h as ds, y_hat, error from ({_ahead(pre)})"),
    }


def loess(name: str, source: str, q: int, jump: int, beyond: int = 0) -> Ctes:
    """``name`` (g, pos, v): regression over the neighbours of each fitted place of ``source`` (g, pos, v)."""
    half = (q - 1) // 2
    return {
        f"{name}_at": ((source,), f"""select g, n, i, case when n <= {q} then 0 else least(greatest(i - {half}, 0), n - {q}) end as lft,
            least({q}, n) as cnt from (select g, n, unnest(list_distinct(list_append(range({-beyond}, n + {beyond}, {jump}), n - 1 + {beyond}))) as i
            from (select g, count(*) as n from {source} group by g))"""),
        f"{name}_near": ((f"{name}_at", source), f"""select a.g, a.i, s.pos - a.i as d, s.v, abs(s.pos - a.i) / far::double as far
            from (select *, greatest(i - lft, lft + cnt - 1 - i) + case when n < {q} then ({q} - n) // 2 else 0 end as far,
                    unnest(range(lft, lft + cnt)) as pos from {name}_at) a join {source} s on s.g = a.g and s.pos = a.pos"""),
        f"{name}_fit": ((f"{name}_near",), f"""select g, i, case when s0 * s2 - s1 * s1 > 1e-6 * s0 * s0
            then (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) else t0 / s0 end as v
            from (select g, i, sum(w) as s0, sum(w * d) as s1, sum(w * d * d) as s2, sum(w * v) as t0, sum(w * d * v) as t1
                  from (select *, case when far <= 0.001 then 1.0::double when far <= 0.999 then (1 - far * far * far) ** 3 else 0 end as w
                        from {name}_near) group by g, i)"""),
        name: ((f"{name}_fit",), f"""select g, pos, case when pos = i then v else v + (v2 - v) * (pos - i) / (i2 - i)::double end as v
            from (select *, unnest(range(i, coalesce(i2, i + 1))) as pos
                  from (select *, lead(i) over w as i2, lead(v) over w as v2 from {name}_fit window w as (partition by g order by i)))"""),
    }


def _mean(source: str, width: int) -> str:
    return f"""select g, pos, v from (select g, pos, avg(v) over w as v, count(*) over w as c from {source}
        window w as (partition by g order by pos rows between current row and {width - 1} following)) where c = {width}"""


def season(pre: str, days: str, period: int, cycles: int) -> Ctes:
    """``pre`` (g, pos, v): the season of ``days`` (g, pos, v)."""
    wide, out, plain = D.windows(period, cycles), {}, days
    for turn in range(1, D.INNER + 1):
        p = f"{pre}_{turn}"
        out[f"{p}_sub"] = ((plain,), f"select g * 1000 + pos % {period} as g, pos // {period} as pos, v from {plain}")
        out |= loess(f"{p}_cyc", f"{p}_sub", cycles, D.jump_of(cycles), 1)
        # places count from one period before the series
        out[f"{p}_long"] = ((f"{p}_cyc",), f"select g // 1000 as g, (pos + 1) * {period} + g % 1000 as pos, v from {p}_cyc")
        out[f"{p}_a"] = ((f"{p}_long",), _mean(f"{p}_long", period))
        out[f"{p}_b"] = ((f"{p}_a",), _mean(f"{p}_a", period))
        out[f"{p}_c"] = ((f"{p}_b",), _mean(f"{p}_b", 3))
        out |= loess(f"{p}_low", f"{p}_c", wide["low"], D.jump_of(wide["low"]))
        name = pre if turn == D.INNER else f"{p}_s"
        out[name] = ((f"{p}_long", f"{p}_low"), f"""select l.g, l.pos, c.v - l.v as v
            from {p}_low l join {p}_long c on c.g = l.g and c.pos = l.pos + {period}""")
        if turn < D.INNER:
            out[f"{p}_rest"] = ((days, name), f"select d.g, d.pos, d.v - s.v as v from {days} d join {name} s using (g, pos)")
            out |= loess(f"{p}_trend", f"{p}_rest", wide["trend"], D.jump_of(wide["trend"]))
            plain = f"{p}_plain"
            out[plain] = ((days, f"{p}_trend"), f"select d.g, d.pos, d.v - s.v as v from {days} d join {p}_trend s using (g, pos)")
    return out


def decomposition(pre: str, filled: str, stops: str) -> Ctes:
    """``pre``: (unique_id, cutoff, ds, y_hat, error) of MSTL at the (unique_id, cutoff) of ``stops``."""
    out: Ctes = {
        f"{pre}_num": ((filled,), f"""select unique_id, ds, y,
            cast(row_number() over (partition by unique_id order by ds) as int) - 1 as t from {filled}"""),
        f"{pre}_stops": ((stops, f"{pre}_num"), f"""select cast(row_number() over (order by unique_id, cutoff) as bigint) as key, unique_id, cutoff,
            t + 1 as n from (select distinct unique_id, cutoff from {stops}) o join {pre}_num d using (unique_id)
            where o.cutoff = d.ds and t + 1 >= {M.MIN_DAYS["MSTL"]}"""),
        f"{pre}_y": ((f"{pre}_stops", f"{pre}_num"), f"""select key as g, cast(t as bigint) as pos, y::double as v
            from {pre}_stops join {pre}_num using (unique_id) where t < n"""),
    }
    rest = f"{pre}_y"
    for period, cycles in zip(M.SEASONS, D.CYCLES):
        part = f"{pre}_{period}"
        out |= season(part, rest, period, cycles)
        out[f"{part}_out"] = ((rest, part), f"select d.g, d.pos, d.v - s.v as v from {rest} d join {part} s using (g, pos)")
        rest = f"{part}_out"
    out[f"{pre}_days"] = ((rest,), f"select g as key, cast(pos as int) as t, v as y from {rest}")
    out |= search(pre, False)
    tails = " ".join(
        f"join {pre}_{p} x{p} on x{p}.g = a.key and x{p}.pos = n - {p} + (h - 1) % {p}" for p in M.SEASONS
    )
    out[pre] = (
        (f"{pre}_best", f"{pre}_stops", *[f"{pre}_{p}" for p in M.SEASONS]),
        f"""select s.unique_id, a.cutoff, a.cutoff + h as ds, y_hat + {" + ".join(f"x{p}.v" for p in M.SEASONS)} as y_hat, error
        from ({_ahead(pre)}) a join {pre}_stops s using (key) {tails}""",
    )
    return out
