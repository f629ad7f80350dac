"""Words anywhere in the documents of an entity are judged, whatever stands around the entity."""

from moodlake.llm import pii


def test_far_short_and_same_surroundings(spark):
    filler = " ".join(f"the report was filed by the clerk {w}" for w in "abcdefghij")
    plain = [(i, f"{filler} on day{i} and sent") for i in range(60)]
    # The name, two letters, far from an address that always stands in the same long signature.
    sign = "with kind regards from the desk of the clerk in the office of the report please write to " * 2 + "joe@x.org " + "the clerk " * 12
    told = [(100 + i, f"Zorbax Qo wrote number{i} and word{i}x . {filler} . {sign}") for i in range(5)]
    rows = plain + told
    found = {r.doc_id: r for r in pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in told:
        at = [x.split(":") for x in found[i].spans.split(",")]
        words = {text[int(a):int(b)] for k, a, b in at if k.startswith("term")}
        assert {"Zorbax", "Qo"} <= words and not {"the", "clerk", "report", f"number{i % 100}"} & words
    assert all(found[i].spans == "" for i, _ in plain)
