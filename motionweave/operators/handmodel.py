"""Hand-mesh forward kinematics as a batch job over Arrow batches.

The model arrays have a fixed size (under a thousand vertices), so they travel as one
broadcast variable.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, StructField, StructType

from ..schemas import NUM_JOINTS, PARENT

# The 16-joint tree of the mesh model and its fingertip vertices.
MODEL_PARENT = (-1, 0, 1, 2, 0, 4, 5, 0, 7, 8, 0, 10, 11, 0, 13, 14)
TIP_VERTEX = {"thumb": 744, "index": 320, "middle": 443, "ring": 555, "pinky": 672}
# Model joints of each finger, in the order of the 21-joint hand.
FINGER_JOINTS = {"thumb": (13, 14, 15), "index": (1, 2, 3), "middle": (4, 5, 6), "ring": (10, 11, 12), "pinky": (7, 8, 9)}
MAX_BYTES = 64 << 20


@dataclass(frozen=True)
class HandModel:
    template: np.ndarray  # [V, 3]
    shape_dirs: np.ndarray  # [V, 3, B]
    regressor: np.ndarray  # [16, V]
    weights: np.ndarray  # [V, 16]
    pose_dirs: np.ndarray | None = None  # [V, 3, 135]
    mirrored: bool = False

    def __post_init__(self):
        n = len(self.template)
        wanted = {"template": (n, 3), "regressor": (16, n), "weights": (n, 16)}
        for name, shape in wanted.items():
            if getattr(self, name).shape != shape:
                raise ValueError(f"{name} must be {shape}, got {getattr(self, name).shape}")
        if self.shape_dirs.shape[:2] != (n, 3):
            raise ValueError("shape_dirs must be [V, 3, B]")
        if self.pose_dirs is not None and self.pose_dirs.shape != (n, 3, 135):
            raise ValueError("pose_dirs must be [V, 3, 135]")
        if n <= max(TIP_VERTEX.values()):
            raise ValueError("the model has too few vertices for its fingertips")
        if not np.allclose(self.weights.sum(axis=1), 1.0, atol=1e-3):
            raise ValueError("skinning weights must sum to 1")
        if self.nbytes > MAX_BYTES:
            raise ValueError("the model is too large to broadcast")

    @property
    def nbytes(self) -> int:
        arrays = (self.template, self.shape_dirs, self.regressor, self.weights, self.pose_dirs)
        return sum(a.nbytes for a in arrays if a is not None)

    @classmethod
    def from_npz(cls, path) -> "HandModel":
        with np.load(path, allow_pickle=False) as z:
            return cls(*[np.asarray(z[k], dtype=float) for k in ("v_template", "shapedirs", "j_regressor", "weights")],
                       np.asarray(z["posedirs"], dtype=float) if "posedirs" in z else None)


def mirror_model(model: HandModel) -> HandModel:
    """Left hand from a right-hand model: reflect x. Pose rotations need ``pose.mirror``."""
    flip = np.array([-1.0, 1.0, 1.0])
    return replace(model, template=model.template * flip, shape_dirs=model.shape_dirs * flip[:, None],
                   pose_dirs=None if model.pose_dirs is None else model.pose_dirs * flip[:, None], mirrored=True)


def landmarks_np(model: HandModel, betas: np.ndarray, hand_pose: np.ndarray, root: np.ndarray,
                 wrist: np.ndarray | None) -> np.ndarray:
    """[B, 21, 3] landmarks. Only the five fingertip vertices are skinned."""
    n = len(betas)
    nb = min(model.shape_dirs.shape[2], betas.shape[1])
    tips = np.array([TIP_VERTEX[f] for f in FINGER_JOINTS])
    # Rest joints are linear in the shape, so the regressor is applied to the basis once.
    base = model.regressor @ model.template
    basis = np.einsum("jv,vck->jck", model.regressor, model.shape_dirs[:, :, :nb])
    rest = base + np.einsum("jck,bk->bjc", basis, betas[:, :nb])
    local = np.concatenate([root[:, None], hand_pose], axis=1)
    tip = model.template[tips] + np.einsum("vck,bk->bvc", model.shape_dirs[tips][:, :, :nb], betas[:, :nb])
    if model.pose_dirs is not None:
        bend = (hand_pose - np.eye(3)).reshape(n, -1)
        tip = tip + np.einsum("vcp,bp->bvc", model.pose_dirs[tips], bend)
    rot = np.empty((n, 16, 3, 3))
    pos = np.empty((n, 16, 3))
    for j, p in enumerate(MODEL_PARENT):
        if p < 0:
            rot[:, j], pos[:, j] = local[:, j], rest[:, j]
        else:
            rot[:, j] = rot[:, p] @ local[:, j]
            pos[:, j] = pos[:, p] + np.einsum("bik,bk->bi", rot[:, p], rest[:, j] - rest[:, p])
    # A vertex follows joint j rigidly: rot_j (x - rest_j) + pos_j.
    offset = pos - np.einsum("bjik,bjk->bji", rot, rest)
    w = model.weights[tips]
    skinned = np.einsum("vj,bjik,bvk->bvi", w, rot, tip) + np.einsum("vj,bji->bvi", w, offset)
    out = np.empty((n, NUM_JOINTS, 3))
    out[:, 0] = pos[:, 0]
    for f, joints in enumerate(FINGER_JOINTS.values()):
        out[:, 1 + 4 * f:4 + 4 * f] = pos[:, list(joints)]
        out[:, 4 + 4 * f] = skinned[:, f]
    return out if wrist is None else out - out[:, :1] + wrist[:, None]


def chains_ok(points: np.ndarray) -> bool:
    """In the rest pose every finger runs away from the wrist."""
    d = np.linalg.norm(points - points[..., :1, :], axis=-1)
    return all(bool(np.all(d[..., c] >= d[..., PARENT[c]])) for c in range(1, NUM_JOINTS))


def check_mapping(model: HandModel) -> bool:
    eye = np.broadcast_to(np.eye(3), (1, 15, 3, 3))
    return chains_ok(landmarks_np(model, np.zeros((1, 10)), eye, np.eye(3)[None], None))


def rest_ok(model: HandModel, betas: np.ndarray) -> np.ndarray:
    """Whether every finger of each shape runs away from the wrist in the rest pose."""
    eye = np.broadcast_to(np.eye(3), (len(betas), 15, 3, 3))
    points = landmarks_np(model, betas, eye, eye[:, 0], None)
    d = np.linalg.norm(points - points[:, :1], axis=-1)
    parent = np.array(PARENT)
    return (d[:, 1:] >= d[:, parent[1:]]).all(axis=1)


def _numbers(col: pa.Array, *tail: int) -> np.ndarray:
    while pa.types.is_list(col.type):
        col = col.flatten()
    return col.to_numpy(zero_copy_only=False).astype(float).reshape(-1, *tail)


def _points(a: np.ndarray, kind: pa.DataType) -> pa.Array:
    flat = pa.StructArray.from_arrays([pa.array(a[..., i].ravel()) for i in range(3)], ["x", "y", "z"])
    return pa.ListArray.from_arrays(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1], flat).cast(kind)


def add_landmarks(hands: DataFrame, models: dict[int, HandModel]) -> DataFrame:
    """Fill ``joints`` (21 points, wrist pinned to ``wrist``) for valid rows of a modelled side, where the rows are.

    Rows: betas, hand_pose (15 x 9), root_rot (9), wrist, side, valid. Other rows keep their joints. A column ``rest_ok``
    says whether the mapping fits the row's own shape: in its rest pose every finger runs away from the wrist. It is NULL
    where nothing was filled.
    """
    for side, model in models.items():
        if not check_mapping(model):
            raise ValueError(f"landmark mapping does not fit the model of side {side}")
    if sum(model.nbytes for model in models.values()) > MAX_BYTES:
        raise ValueError("the models are too large to broadcast together")
    shared = hands.sparkSession.sparkContext.broadcast(models)
    names = hands.columns

    def run(batches):
        flip = np.diag([-1.0, 1.0, 1.0])
        for batch in batches:
            n = batch.num_rows
            old = batch.column("joints")
            take, flags = np.arange(n), np.zeros(n, bool)
            made, filled = [old], n
            valid = pc.fill_null(batch.column("valid"), False).to_numpy(zero_copy_only=False)
            sides = pc.fill_null(batch.column("side"), -1).to_numpy(zero_copy_only=False)
            for side, model in shared.value.items():
                at = np.flatnonzero(valid & (sides == side))
                if not len(at):
                    continue
                rows = batch.take(pa.array(at))
                betas = _numbers(rows.column("betas"), rows.column("betas").value_lengths()[0].as_py())
                pose, root = _numbers(rows.column("hand_pose"), 15, 3, 3), _numbers(rows.column("root_rot"), 3, 3)
                wrist = np.column_stack([pc.struct_field(rows.column("wrist"), i).to_numpy(zero_copy_only=False) for i in range(3)])
                if model.mirrored:
                    pose, root = flip @ pose @ flip, flip @ root @ flip
                made.append(_points(landmarks_np(model, betas, pose, root, wrist), old.type))
                take[at] = filled + np.arange(len(at))
                flags[at] = rest_ok(model, betas)
                filled += len(at)
            joints = pa.concat_arrays(made).take(pa.array(take))
            columns = [joints if c == "joints" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(flags, mask=take < n)], names=[*names, "rest_ok"])

    return hands.mapInArrow(run, StructType([*hands.schema.fields, StructField("rest_ok", BooleanType())]))
