from __future__ import annotations

import numpy as np
import pytest

from lumenloom.queries.images import png
from lumenloom.sources import images


def flat(r, g, b, h=4, w=6):
    return np.tile(np.array([r, g, b], np.uint8), (h, w, 1))


@pytest.fixture
def features(spark, tmp_path):
    ramp = np.repeat(np.arange(0, 80, 10, dtype=np.uint8)[None, :, None], 3, axis=0)
    stripes = np.zeros((4, 6, 3), np.uint8)
    stripes[:, ::2] = [200, 100, 50]
    alpha = np.dstack([flat(10, 20, 30), np.full((4, 6, 1), 128, np.uint8)])
    bodies = {
        1: png(flat(100, 50, 200)),
        2: png(ramp),
        3: png(stripes),
        4: png(alpha),
        5: b"this is no image",
        6: png(flat(0, 0, 0)),
        7: png(flat(9, 9, 9, h=3, w=1)),
    }
    for i, body in bodies.items():
        (tmp_path / f"{i}.png").write_bytes(body)
    got = images.image_features(images.read_images(spark, str(tmp_path)))
    return {r.id: r for r in got.collect()}, bodies


def test_flat_image(features):
    got, bodies = features
    f = got[1]
    assert (f.mean_r, f.mean_g, f.mean_b) == (100.0, 50.0, 200.0)
    assert (f.std_r, f.std_g, f.std_b, f.contraste_luminancia) == (0.0, 0.0, 0.0, pytest.approx(0, abs=1e-9))
    assert f.brightness == pytest.approx(0.299 * 100 + 0.587 * 50 + 0.114 * 200)
    assert f.complexidade_visual == pytest.approx(0, abs=1e-9)
    assert f.saturacao_media == int(255 * 150 / 200)
    assert f.file_size_bytes == len(bodies[1])


def test_gray_ramp(features):
    f = features[0][2]
    levels = np.arange(0, 80, 10)
    assert f.mean_r == f.mean_g == f.mean_b == levels.mean()
    assert f.std_r == pytest.approx(levels.std())
    assert f.complexidade_visual == pytest.approx(10)
    assert f.saturacao_media == 0


def test_stripes(features):
    f = features[0][3]
    lum = 0.299 * 200 + 0.587 * 100 + 0.114 * 50
    assert (f.mean_r, f.std_r) == (100.0, 100.0)
    assert f.complexidade_visual == pytest.approx(lum)
    assert f.saturacao_media == pytest.approx(int(255 * 150 / 200) / 2)


def test_alpha_is_ignored(features):
    f = features[0][4]
    assert (f.mean_r, f.mean_g, f.mean_b) == (10.0, 20.0, 30.0)


def test_undecodable_image_has_no_features(features):
    assert all(v is None for k, v in features[0][5].asDict().items() if k != "id")


def test_black_and_narrow_images(features):
    assert features[0][6].saturacao_media == 0
    assert features[0][7].complexidade_visual is None and features[0][7].mean_r == 9


def test_products_without_image_stay(spark, features):
    products = spark.createDataFrame([(1,), (5,), (99,)], "id int")
    rows = [tuple(features[0][i]) for i in (1, 5)]
    feats = spark.createDataFrame(rows, images.FEATURE_SCHEMA)
    got = {r.id: r.mean_r for r in images.attach_features(products, feats).collect()}
    assert got == {1: 100.0, 5: None, 99: None}


def test_saturation_truncates_like_single_precision():
    # every pair of maximum and spread, against the rule worked out with plain floats
    for high in range(1, 256):
        spread = np.arange(high + 1)
        rgb = np.zeros((1, high + 1, 3), np.uint8)
        rgb[0, :, 0] = high
        rgb[0, :, 1] = rgb[0, :, 2] = high - spread
        bgr = rgb[:, :, ::-1].tobytes()
        want = [int(float(np.float32(s) / np.float32(high)) * 255.0) for s in spread]
        got = images.pixel_features(bgr, 1, high + 1, 3)[7]
        assert got == pytest.approx(np.mean(want))
