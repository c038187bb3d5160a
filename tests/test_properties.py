"""Properties on generated inputs."""

from hypothesis import given, settings
from hypothesis import strategies as st

from docloom import reports
from docloom.operators import forms
from docloom.sources import markup


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(-1, 4), st.integers(-1, 4)), max_size=5), max_size=6))
def test_grid_is_a_rectangle_of_whole_cells(rows):
    g = markup.grid(rows)
    assert len({len(r) for r in g}) <= 1
    for r, line in enumerate(g):
        for c, p in enumerate(line):
            if p:
                down, across = rows[p[0]][p[1]]
                assert p[0] <= r < p[0] + down and across >= 1 and (c == 0 or line[c - 1] != p or across > 1)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("<>/&;ptdrh1'=\" abtable한#")), max_size=80))
def test_any_markup_is_read(source):
    root = markup.tree(source)
    assert all(b["kind"] in ("h", "p", "kv", "t") for b in markup.blocks(root))
    list(markup.nodes(root)), list(forms.facts(root)), list(forms.form_values(root))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.booleans()), max_size=8))
def test_every_value_is_paired_or_has_no_label(cells):
    got = forms.pair(cells, suffix=False)
    labelled = [v for k, (v, is_label) in enumerate(cells) if not is_label and any(x[1] for x in cells[:k])]
    assert [v for _, v in got] == labelled and all(keys for keys, _ in got)


@settings(max_examples=100, deadline=None)
@given(st.text("ab\n", max_size=20), st.lists(st.tuples(st.integers(1, 5), st.just("note")), max_size=4))
def test_notices_keep_the_lines(text, notices):
    lines = reports.insert_notices(text, notices).split("\n")
    assert [x for x in lines[1:] if x != "note"] == text.split("\n") and lines.count("note") == len(notices)
