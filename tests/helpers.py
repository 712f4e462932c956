"""Seeded fixtures and brute-force counterparts."""

import base64
import zlib

import numpy as np

from peakloom import schemas


def spectra_frame(spark, rows):
    """Rows as dicts with path, scan, precursor_mz, charge, mz, intensity."""
    full = []
    for r in rows:
        full.append(
            {
                "path": r["path"],
                "filename": r["path"].rsplit("/", 1)[-1],
                "scan": r["scan"],
                "ms_level": 2,
                "precursor_mz": r.get("precursor_mz"),
                "rt_sec": r.get("rt_sec", 0.0),
                "charge": r.get("charge"),
                "title": None,
                "mz": [float(v) for v in r["mz"]],
                "intensity": [float(v) for v in r["intensity"]],
            }
        )
    return spark.createDataFrame(full, schemas.SPECTRUM)


def random_spectra(seed, families=12, size=8, path="/d/a.mzML", jitter=3e-6, start=1):
    """Families of similar spectra with masses close together, and loners."""
    rng = np.random.default_rng(seed)
    rows, scan = [], start
    for f in range(families):
        mz = np.sort(rng.uniform(100, 900, 20))
        inten = rng.uniform(10, 100, 20)
        mass = rng.uniform(300, 900)
        for _ in range(size):
            rows.append(
                dict(
                    path=path, scan=scan, precursor_mz=float(mass * (1 + rng.normal(0, jitter))), charge=1 + f % 2,
                    mz=mz, intensity=inten * rng.uniform(0.6, 1.4, 20), rt_sec=float(rng.uniform(0, 3600)),
                )
            )
            scan += 1
    for _ in range(families):
        rows.append(
            dict(
                path=path, scan=scan, precursor_mz=float(rng.uniform(300, 900)), charge=1,
                mz=np.sort(rng.uniform(100, 900, 20)), intensity=rng.uniform(10, 100, 20), rt_sec=1.0,
            )
        )
        scan += 1
    return rows


def vector(row, width):
    out = {}
    for m, i in zip(row["mz"], row["intensity"], strict=True):
        b = int(np.floor(m / width))
        out[b] = out.get(b, 0.0) + i
    norm = np.sqrt(sum(v * v for v in out.values()))
    return {b: v / norm for b, v in out.items()}


def dbscan(rows, params):
    """Labels by brute force: components of the eps-graph, -1 for isolated spectra."""
    n = len(rows)
    vecs = [vector(r, params.fragment_tol) if len(r["mz"]) else {} for r in rows]
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    linked = [False] * n
    tol = params.precursor_tol
    for a in range(n):
        for b in range(a + 1, n):
            ma, mb = rows[a]["precursor_mz"], rows[b]["precursor_mz"]
            window = tol.value if tol.unit == "da" else tol.relative * max(ma, mb)
            if rows[a]["charge"] != rows[b]["charge"] or abs(ma - mb) > window:
                continue
            dot = sum(w * vecs[b].get(k, 0.0) for k, w in vecs[a].items())
            if dot >= params.similarity:
                linked[a] = linked[b] = True
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    order = sorted(range(n), key=lambda k: (rows[k]["path"], rows[k]["scan"]))
    ids, labels = {}, {}
    for k in order:
        key = (rows[k]["path"], rows[k]["scan"])
        labels[key] = ids.setdefault(find(k), len(ids)) if linked[k] else -1
    return labels


def _encode(values, packed, double):
    raw = np.asarray(values, "<f8" if double else "<f4").tobytes()
    return base64.b64encode(zlib.compress(raw) if packed else raw).decode()


def mzml_text(spectra, packed=True, double=True, minutes=False, shared=False):
    """A small mzML document. Each spectrum: scan, level, mass, charge, rt, mz, intensity."""
    groups = (
        '<referenceableParamGroupList count="1"><referenceableParamGroup id="ms2">'
        '<cvParam cvRef="MS" accession="MS:1000511" name="ms level" value="2"/>'
        "</referenceableParamGroup></referenceableParamGroupList>"
    )
    parts = [f'<?xml version="1.0"?><indexedmzML><mzML xmlns="http://psi.hupo.org/ms/mzml">{groups}<run><spectrumList count="{len(spectra)}">']
    for n, s in enumerate(spectra):
        level = (
            '<referenceableParamGroupRef ref="ms2"/>'
            if shared and s.get("level", 2) == 2
            else f'<cvParam cvRef="MS" value="{s.get("level", 2)}" accession="MS:1000511" name="ms level"/>'
        )
        unit = 'unitAccession="UO:0000031" unitName="minute"' if minutes else 'unitAccession="UO:0000010" unitName="second"'
        rt = s["rt"] / 60 if minutes else s["rt"]
        charge = (
            f'<cvParam cvRef="MS" accession="MS:1000041" name="charge state" value="{s["charge"]}"/>' if s.get("charge") else ""
        )
        ion = "" if s.get("level", 2) != 2 else (
            '<precursorList count="1"><precursor><selectedIonList count="1"><selectedIon>'
            f'<cvParam cvRef="MS" accession="MS:1000744" name="selected ion m/z" value="{s["mass"]}"/>{charge}'
            "</selectedIon></selectedIonList></precursor></precursorList>"
        )
        if s.get("no_ion"):
            ion = ""
        kind = "MS:1000574" if packed else "MS:1000576"
        size = "MS:1000523" if double else "MS:1000521"
        arrays = "".join(
            f'<binaryDataArray><cvParam accession="{size}" name="b"/><cvParam accession="{kind}" name="c"/>'
            f'<cvParam accession="{acc}" name="a"/><binary>{_encode(s[name], packed, double)}</binary></binaryDataArray>'
            for acc, name in (("MS:1000514", "mz"), ("MS:1000515", "intensity"))
        )
        parts.append(
            f'<spectrum index="{n}" id="controllerType=0 controllerNumber=1 scan={s["scan"]}" defaultArrayLength="{len(s["mz"])}">{level}'
            f'<scanList count="1"><scan><cvParam accession="MS:1000016" name="scan start time" value="{rt}" {unit}/></scan></scanList>'
            f'{ion}<binaryDataArrayList count="2">{arrays}</binaryDataArrayList></spectrum>\n'
        )
    parts.append("</spectrumList></run></mzML><indexList></indexList></indexedmzML>")
    return "".join(parts)
