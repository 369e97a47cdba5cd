"""Secrets directly after an equals sign, with spans written by hand."""

from lossloom.llm import secrets as s

HEX = "24be6443a1b0c9d8e7f60123"
AWS = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
CASES = [
    (1, f"API_KEY={HEX}", [(8, 32, 1)]),
    (2, f"see url?token={HEX}&x=1", [(14, 38, 1)]),
    (3, f"aws_secret_access_key={AWS}", [(0, 21, 0), (22, 62, 1)]),
    (4, f'aws_secret_access_key = "{AWS}"', [(0, 21, 0), (25, 65, 1)]),
    (5, f"data {HEX}==, end", [(5, 31, 0)]),
    (6, f"same_long_name_of_it=={HEX}", [(0, 20, 0), (22, 46, 0)]),
]


def test_values_after_an_equals_sign_are_candidates(spark):
    docs = spark.createDataFrame([(i, t, "a") for i, t, _ in CASES],
                                 "doc_id long, text string, path string")
    found = s.with_features(s.candidates(docs, "doc_id", "text", "path"), bytes(26 ** 3)).collect()
    for i, text, want in CASES:
        got = sorted((r.start, r.end, int(r.assigned)) for r in found if r.doc_id == i)
        assert got == want, text
    assert {r.m for r in found if r.doc_id == 3} == {"aws_secret_access_key", AWS}
