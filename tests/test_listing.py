"""Rows of listing pages that lack a field."""

from subtlake.functions.listing import extract_listing


def test_a_row_without_votes_keeps_to_itself(spark):
    row = '<tr onclick="x"><td id="name{0}"></td><td><a href="/y">{0}x\n</a><br>{1}</td><td><a href="/en/profile/iduser-{0}">u</a></td></tr>'
    page = "<table>" + row.format(1, "") + row.format(2, '<span title="9 votes">7.5</span>') + "</table>"
    got = spark.createDataFrame([(page,), ("no rows",), (None,)], "html string").select(extract_listing("html").alias("r")).collect()
    assert [tuple(x) for x in got[0].r] == [(1, 1, None, None, 1), (2, 2, 75, 9, 2)]
    assert got[1].r == [] and got[2].r is None
