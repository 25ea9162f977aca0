"""Charts of the statistics as SVG files: pie, horizontal, stacked and grouped bars.

A chart's rows are counts and shares over levels, skills or one level's nodes; they are the only thing that is collected.
"""

from __future__ import annotations

import math
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH, HEIGHT, EDGE = 1000, 650, 60
#: The colours of slices and series, in turn.
PALETTE = ("#3B82F6", "#10B981", "#F59E0B", "#EF4444", "#8B5CF6", "#14B8A6", "#A855F7", "#F97316", "#22C55E", "#06B6D4")

Series = dict[str, list[float]]


def _colour(k: int) -> str:
    return PALETTE[k % len(PALETTE)]


def _text(x: float, y: float, s: str, anchor: str = "start", size: int = 14) -> str:
    return f'<text x="{x:.1f}" y="{y:.1f}" text-anchor="{anchor}" font-size="{size}" font-family="sans-serif">{escape(s)}</text>'


def _box(x: float, y: float, w: float, h: float, colour: str, tip: str) -> str:
    return f'<rect x="{x:.1f}" y="{y:.1f}" width="{max(0.0, w):.1f}" height="{max(0.0, h):.1f}" fill="{colour}"><title>{escape(tip)}</title></rect>'


def _page(title: str, body: list[str], height: float = HEIGHT) -> str:
    head = f'<svg xmlns="http://www.w3.org/2000/svg" width="{WIDTH}" height="{height:.0f}" viewBox="0 0 {WIDTH} {height:.0f}"><rect width="100%" height="100%" fill="white"/>'
    return "\n".join([head, _text(WIDTH / 2, 30, title, "middle", 18), *body, "</svg>"])


def _legend(names: list[str]) -> list[str]:
    return [part for k, name in enumerate(names) for part in (_box(WIDTH - 190, 60 + 22 * k, 14, 14, _colour(k), name), _text(WIDTH - 170, 72 + 22 * k, name))]


def pie(labels: list[str], values: list[float], title: str) -> str:
    """A slice for each label, clockwise from the top; nothing where all values are 0."""
    total, at, out = sum(values), 0.0, []
    x, y, r = WIDTH * 0.4, HEIGHT / 2 + 15, HEIGHT * 0.38
    for k, (label, v) in enumerate(zip(labels, values, strict=True)):
        if not v:
            continue
        a, b = (2 * math.pi * t / total - math.pi / 2 for t in (at, at + v))
        at += v
        tip = f"<title>{escape(f'{label}: {v:g}')}</title>"
        if v == total:
            out.append(f'<circle cx="{x}" cy="{y}" r="{r}" fill="{_colour(k)}">{tip}</circle>')
            continue
        ends = [f"{x + r * math.cos(t):.2f} {y + r * math.sin(t):.2f}" for t in (a, b)]
        out.append(f'<path d="M {x} {y} L {ends[0]} A {r} {r} 0 {int(b - a > math.pi)} 1 {ends[1]} Z" fill="{_colour(k)}">{tip}</path>')
    return _page(title, out + _legend(labels))


def bars(labels: list[str], values: list[float], title: str) -> str:
    """A horizontal bar for each label; the page grows with their number."""
    most, left, step = max([*values, 0]) or 1, 260, 22
    out = []
    for k, (label, v) in enumerate(zip(labels, values, strict=True)):
        y = EDGE + step * k
        width = (WIDTH - left - EDGE) * v / most
        out += [_text(left - 8, y + 13, label, "end", 12), _box(left, y, width, step - 6, PALETTE[0], f"{label}: {v:g}"), _text(left + width + 4, y + 13, f"{v:g}", size=11)]
    return _page(title, out, max(HEIGHT, EDGE * 2 + step * len(labels)))


def _columns(labels: list[str], series: Series, title: str, stacked: bool) -> str:
    rows = list(zip(*series.values(), strict=True)) if series else []
    most = max([sum(r) if stacked else max(r) for r in rows] + [0]) or 1
    high, low = EDGE, HEIGHT - EDGE
    slot = (WIDTH - 200 - 2 * EDGE) / max(1, len(labels))
    out = [_text(EDGE - 6, y + 4, f"{v:g}", "end", 11) for v, y in ((0, low), (round(most, 2), high))]
    for k, (label, row) in enumerate(zip(labels, rows, strict=True)):
        x, top, width = EDGE + slot * k + slot * 0.1, low, slot * 0.8 / (1 if stacked else max(1, len(series)))
        for n, (name, v) in enumerate(zip(series, row, strict=True)):
            h = (low - high) * v / most
            top = top - h if stacked else low - h
            out.append(_box(x if stacked else x + width * n, top, width, h, _colour(n), f"{label}, {name}: {v:g}"))
        out.append(_text(EDGE + slot * (k + 0.5), low + 20, label, "middle", 12))
    return _page(title, out + _legend(list(series)))


def stacked_bars(labels: list[str], series: Series, title: str) -> str:
    """A column for each label, the series on top of each other."""
    return _columns(labels, series, title, True)


def grouped_bars(labels: list[str], series: Series, title: str) -> str:
    """A group of columns for each label, one a series."""
    return _columns(labels, series, title, False)


def _pivoted(rows: list, label: str, name: str, value: str) -> tuple[list[str], Series]:
    cells = {(r[label], r[name]): float(r[value]) for r in rows}
    labels, names = sorted({k[0] for k in cells}), sorted({k[1] for k in cells})
    return [f"Level {x}" for x in labels], {n: [cells.get((x, n), 0.0) for x in labels] for n in names}


def render(data: dict[str, DataFrame]) -> dict[str, str]:
    """SVG text by chart name, of what :func:`lectern.operators.stats.charts` gives; the nodes have a chart for each level."""
    out = {}
    for name, title in (("question-by-level", "Questions by level"), ("skill-x-question-type", "Skill and question type")):
        rows = data[name].orderBy("label").collect()
        out[name] = pie([r["label"] for r in rows], [float(r["total"]) for r in rows], title)
    out["skill-ratio-by-level"] = stacked_bars(*_pivoted(data["skill-ratio-by-level"].collect(), "level_id", "skill", "percent"), "Share of each skill by level (%)")
    rows = data["node-balance-by-skill"].orderBy("skill").collect()
    out["node-balance-by-skill"] = grouped_bars([r["skill"] for r in rows], {k.title(): [float(r[k]) for r in rows] for k in ("min", "median", "max", "std")}, "Questions per node within each skill")
    rows = data["node-coverage-by-level"].orderBy("level_id").collect()
    shares = {"above lower bound": "above_lower_bound_percent", "below upper bound": "below_upper_bound_percent"}
    out["node-coverage-by-level"] = grouped_bars([f"Level {r['level_id']}" for r in rows], {k: [float(r[c]) for r in rows] for k, c in shares.items()}, "Nodes above and below the bounds (%)")
    rows = data["balance-score-by-level"].orderBy("level_id").collect()
    out["balance-score-by-level"] = bars([f"Level {r['level_id']}" for r in rows], [float(r["balance_score"]) for r in rows], "Balance score by level")
    for level in [r[0] for r in data["node-distribution"].select("level_id").distinct().orderBy("level_id").collect()]:
        rows = data["node-distribution"].where(F.col("level_id") == level).orderBy("order_index", "label").collect()
        out[f"node-distribution-level-{level}"] = bars([r["label"] for r in rows], [float(r["total"]) for r in rows], f"Questions by node, level {level}")
    return out


def write_charts(data: dict[str, DataFrame], folder: str) -> None:
    """A file NAME.svg for each chart, on any file system that Spark writes to."""
    spark = next(iter(data.values())).sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, svg in render(data).items():
        out = files.create(path(f"{folder}/{name}.svg"), True)
        out.write(svg.encode())
        out.close()
