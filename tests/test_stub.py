"""The stand-in annotator of the harness."""

import json
import sys

from harness.stub import make_annotator


def calls(wire):
    """Python functions called for a text, by an annotator that has seen it before."""
    annotator, n = make_annotator(), 0
    annotator(wire)

    def count(frame, event, arg):
        nonlocal n
        n += event == "call"

    sys.setprofile(count)
    try:
        annotator(wire)
    finally:
        sys.setprofile(None)
    return n


def test_no_call_per_token():
    words = [f"w{i}" for i in range(2000)]
    assert calls("\n".join(words) + "\n\n") < 200


def test_escapes_and_lower_case_by_token():
    wire = 'Σ"Σ\nΑΣ\n\\n\nb\x1f.\nİx\n\n\nlast\n\n'
    response = json.loads(make_annotator()(wire))
    lines = [line.split("\t") for line in response["md_lattice"].split("\n") if line]
    tokens = ['Σ"Σ', "ΑΣ", "\\n", "b\x1f.", "İx", "last"]
    assert [line[2] for line in lines] == tokens
    assert [line[3] for line in lines] == [t.lower() for t in tokens]
    assert response["md_lattice"].endswith("\n\n")
    assert response["ma_lattice"].startswith('0\t1\tΣ"Σ\n0\t1\tΑΣ\n0\t1\t\\n\n')
    assert response["segmented_text"] == 'Σ"Σ ΑΣ \\n b\x1f. İx   last'
    assert [line.split("\t")[1] for line in response["dep_tree"].split("\n") if line] == tokens[:5]
