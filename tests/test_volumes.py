"""What belongs to a volume of a book file with several."""

import io
import zipfile

from tesserae.sources import files

PARTS = {
    "OPS/one.xhtml": '<link href="css/main.css"/><img src="img/map%20one.png"/><a href="two.xhtml#x">on</a><a href="http://x.org/y.css">out</a>',
    "OPS/one-b.xhtml": "<p>plain</p>",
    "OPS/two.xhtml": "<link href='css/main.css'/><link href='css/two.css'/><a href='notes.xhtml'>n</a>",
    "OPS/notes.xhtml": '<img src="img/note.svg"/><a href="two.xhtml">back</a>',
    "OPS/css/main.css": "@import 'base.css'; body { background: url(../img/paper.png) }",
    "OPS/css/base.css": "@font-face { src: url('../fonts/a.ttf?v=1') } @import \"main.css\";",
    "OPS/css/two.css": "p { src: url(none.png) }",
    "OPS/img/map one.png": "png", "OPS/img/paper.png": "png", "OPS/img/note.svg": "<svg/>", "OPS/img/unused.png": "png", "OPS/fonts/a.ttf": "ttf",
}


def packed():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in PARTS.items():
            z.writestr(name, text)
    return out.getvalue()


def test_shared_and_unshared_assets(spark, tmp_path):
    (tmp_path / "a.epub").write_bytes(packed())
    (tmp_path / "b.epub").write_bytes(packed())
    linked = files.links(spark, str(tmp_path))
    paths = sorted(r["file"] for r in linked.select("file").distinct().collect())
    assert len(paths) == 2
    pages = [(paths[0], 1, "OPS/one.xhtml"), (paths[0], 1, "OPS/one-b.xhtml"), (paths[0], 2, "OPS/two.xhtml"), (paths[1], 1, "OPS/two.xhtml")]
    found = files.volume_files(spark.createDataFrame(pages, "file string, volume int, href string"), linked).collect()
    of = lambda f, v: {(r["name"].removeprefix("OPS/"), r["asset"]) for r in found if r["file"] == paths[f] and r["volume"] == v}
    shared = {("css/main.css", True), ("css/base.css", True), ("img/paper.png", True), ("fonts/a.ttf", True)}
    assert of(0, 1) == {("one.xhtml", False), ("one-b.xhtml", False), ("img/map one.png", True)} | shared
    assert of(0, 2) == {("two.xhtml", False), ("css/two.css", True), ("notes.xhtml", True), ("img/note.svg", True)} | shared
    assert of(1, 1) == of(0, 2)
    assert len(found) == len({(r["file"], r["volume"], r["name"]) for r in found})
    none = files.volume_files(spark.createDataFrame([], "file string, volume int, href string"), linked)
    assert none.count() == 0
