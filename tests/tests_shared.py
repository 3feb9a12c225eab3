"""A small source folder that several tests convert."""

import numpy as np

from tessera.functions import png


def make(root, normal=20, anomaly=10):
    rng = np.random.default_rng(761)
    data = root / "set" / "thing" / "Data"
    for d in ("Images/Normal", "Images/Anomaly", "Masks/Anomaly"):
        (data / d).mkdir(parents=True)
    for i in range(normal):
        (data / "Images/Normal" / f"{i:03}.png").write_bytes(png.encode(rng.integers(0, 256, (80, 100, 3), dtype=np.uint8)))
    for i in range(anomaly):
        (data / "Images/Anomaly" / f"{i:03}.png").write_bytes(png.encode(rng.integers(0, 256, (80, 100, 3), dtype=np.uint8)))
        mask = np.zeros((80, 100), np.uint8)
        mask[10:20, 20:40], mask[40:45, 60:70] = i % 6 + 1, (i + 2) % 6 + 1
        (data / "Masks/Anomaly" / f"{i:03}.png").write_bytes(png.encode(mask))
    return data
