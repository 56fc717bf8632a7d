"""Bar charts of small frames as SVG files; frames larger than a chart can show are refused."""

from __future__ import annotations

from xml.sax.saxutils import escape

from pyspark.sql import DataFrame

#: Bars of a chart.
MOST_BARS = 1_000


def _rows(df: DataFrame, label: str, value: str) -> list[tuple[str, float]]:
    rows = df.select(f"`{label}`", f"`{value}`").limit(MOST_BARS + 1).collect()
    if len(rows) > MOST_BARS:
        raise ValueError(f"more than {MOST_BARS} bars")
    return [("" if r[0] is None else str(r[0]), float(r[1] or 0)) for r in rows]


def _write(path: str, width: float, height: float, title: str, parts: list[str]) -> None:
    head = f'<svg xmlns="http://www.w3.org/2000/svg" width="{width:g}" height="{height:g}" font-family="sans-serif" font-size="11">'
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([head, f'<text x="{width / 2:g}" y="18" text-anchor="middle" font-size="14">{escape(title)}</text>', *parts, "</svg>\n"]))


def columns(df: DataFrame, label: str, value: str, path: str, title: str = "") -> None:
    """Upright bars in the order of the rows, such as a timeline; no rows give an empty chart."""
    rows = _rows(df, label, value)
    top, step, width = max((v for _, v in rows), default=0.0) or 1.0, 36, 36 * len(rows) + 40
    parts = []
    for i, (name, v) in enumerate(rows):
        x, high = 20 + i * step, 260 * v / top
        parts.append(f'<rect x="{x + 4:g}" y="{300 - high:g}" width="{step - 8}" height="{high:g}" fill="#1f77b4" stroke="black"/>')
        parts.append(f'<text x="{x + step / 2:g}" y="{295 - high:g}" text-anchor="middle">{v:g}</text><text x="{x + step / 2:g}" y="316" text-anchor="middle">{escape(name)}</text>')
    _write(path, width, 330, title, parts)


def bars(df: DataFrame, label: str, value: str, path: str, title: str = "") -> None:
    """Lying bars, the first row at the top, such as a ranking."""
    rows = _rows(df, label, value)
    top = max((v for _, v in rows), default=0.0) or 1.0
    parts = []
    for i, (name, v) in enumerate(rows):
        y = 30 + i * 20
        parts.append(f'<text x="290" y="{y + 13}" text-anchor="end">{escape(name)}</text><rect x="300" y="{y + 2}" width="{460 * v / top:g}" height="16" fill="#2ca02c" stroke="black"/>')
        parts.append(f'<text x="{305 + 460 * v / top:g}" y="{y + 14}">{v:g}</text>')
    _write(path, 820, 40 + 20 * len(rows), title, parts)
