"""Image tree source and anomaly scoring on tiny generated PNGs."""
import os
import struct
import zlib

import numpy as np

from forgeline.operators import images as im


def write_png(path, rgb):
    h, w, _ = rgb.shape
    raw = b"".join(b"\x00" + rgb[y].astype(np.uint8).tobytes() for y in range(h))

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) \
        + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    with open(path, "wb") as f:
        f.write(png)


def make_tree(root):
    specs = [("train", "good", 0, (120, 120, 120)), ("train", "good", 1, (122, 118, 121)),
             ("test", "good", 0, (121, 119, 120)), ("test", "crack", 0, (120, 120, 120))]
    for split, defect, i, colour in specs:
        d = os.path.join(root, "bottle", split, defect)
        os.makedirs(d, exist_ok=True)
        img = np.zeros((8, 12, 3), dtype=np.uint8) + np.array(colour, dtype=np.uint8)
        if defect == "crack":
            img[2:5, 3:7] = (250, 10, 10)
        write_png(os.path.join(d, f"{i:03d}.png"), img)


def test_image_tree_and_scores(spark, tmp_dir):
    make_tree(tmp_dir)
    df = im.read_image_tree(spark, tmp_dir)
    rows = {(r["split"], r["defect"]): r["label"] for r in df.collect()}
    assert rows == {("train", "good"): 0, ("test", "good"): 0, ("test", "crack"): 1}
    g = im.image_grid(df, size=4)
    first = g.where("split = 'train'").first()["pixels"]
    assert len(first) == 4 * 4 * 3 and all(0.0 <= x <= 1.0 for x in first)
    normal = im.fit_normal_image(g.where("split = 'train' AND label = 0"))
    scored = im.image_score(im.error_maps(g.where("split = 'test'"), normal, 4, kernel=3))
    s = {r["defect"]: r["score"] for r in scored.collect()}
    assert s["crack"] > s["good"]
    hm = im.normalise_map(scored).first()["heatmap"]
    assert min(hm) == 0.0 and abs(max(hm) - 255.0) < 1e-9


def test_gaussian_kernel_sigma_from_size():
    k = im.gaussian_kernel(15)
    assert abs(k.sum() - 1) < 1e-12 and k.argmax() == 7
    assert abs(0.3 * ((15 - 1) * 0.5 - 1) + 0.8 - 2.6) < 1e-12


def test_image_evaluate_workflow(spark, tmp_dir):
    from forgeline import workflows as wf
    make_tree(tmp_dir)
    scored, metrics = wf.image_evaluate(spark, tmp_dir, "bottle", size=4, kernel=3)
    m = metrics.first()
    assert m["auroc"] == 1.0 and m["f1"] == 1.0
    v = {r["defect"]: r["verdict"] for r in scored.collect()}
    assert v == {"crack": "NG", "good": "OK"}
