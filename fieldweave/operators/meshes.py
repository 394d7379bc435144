"""Triangular meshes of the sphere, refined from the icosahedron, and points on them.

A mesh of n splits has 20 * 4 ** n faces: a parameter, not the data, bounds it, so it may be made on the driver and sent
to all tasks. Points meet it by descent: first the 20 faces, then the four children of the face that holds the point.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import latlon
from ..sources.tables import kept
from .graphs import face_edges, within_radius
from .ordering import numbered
from .spheres import edge_features


def icosahedron() -> tuple[np.ndarray, np.ndarray]:
    """Vertices [12, 3], turned so that two faces lie flat at the poles, and faces [20, 3], counter-clockwise from outside."""
    golden = (1 + math.sqrt(5)) / 2
    corners = np.array([np.roll((0.0, s, t * golden), k) for k in range(3) for s in (1, -1) for t in (1, -1)]) / math.hypot(1, golden)
    side = np.linalg.norm(corners[0] - corners, axis=1)
    side = side[side > 1e-9].min() * 1.01
    faces = [f for f in combinations(range(12), 3) if all(np.linalg.norm(corners[a] - corners[b]) < side for a, b in combinations(f, 2))]
    faces = [(a, b, c) if np.linalg.det(corners[[a, b, c]]) > 0 else (a, c, b) for a, b, c in faces]
    up = corners[list(faces[0])].sum(axis=0)
    up /= np.linalg.norm(up)
    along = np.cross(up, corners[faces[0][0]])
    along /= np.linalg.norm(along)
    return corners @ np.column_stack([np.cross(along, up), along, up]), np.array(faces)


def split(vertices: np.ndarray, faces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each face in four; new vertices are the edges' middles on the sphere, one an edge. Child 4 * f + k lies in face f."""
    edges = np.sort(np.concatenate([faces[:, [0, 1]], faces[:, [1, 2]], faces[:, [2, 0]]]), axis=1)
    own, at = np.unique(edges, axis=0, return_inverse=True)
    middle = vertices[own].sum(axis=1)
    middle /= np.linalg.norm(middle, axis=1, keepdims=True)
    ab, bc, ca = at.reshape(3, -1) + len(vertices)
    a, b, c = faces.T
    children = np.stack([np.stack(t, axis=1) for t in ((a, ab, ca), (ab, b, bc), (ca, bc, c), (ab, bc, ca))], axis=1)
    return np.concatenate([vertices, middle]), children.reshape(-1, 3)


def hierarchy(splits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The finest vertices, of which each level's are a prefix, and the faces of all levels."""
    vertices, faces = icosahedron()
    levels = [faces]
    for _ in range(splits):
        vertices, faces = split(vertices, faces)
        levels.append(faces)
    return vertices, levels


def face_table(spark: SparkSession, splits: int) -> DataFrame:
    """level, face, parent (face of the level before, or 0), a, b, c, and the vertices' positions as pa, pb, pc."""
    vertices, levels = hierarchy(splits)
    at = vertices.tolist()
    rows = [(n, f, f // 4 if n else 0, *map(int, t), *(at[v] for v in t)) for n, faces in enumerate(levels) for f, t in enumerate(faces)]
    return spark.createDataFrame(rows, "level int, face long, parent long, a int, b int, c int, pa array<double>, pb array<double>, pc array<double>")


def label(previous: str | None, splits: int) -> str:
    """The name of a mesh that another is split into: its splits, behind those of the mesh before."""
    return str(splits) if not previous else f"{previous}_{splits}"


def merged_faces(spark: SparkSession, splits: int) -> DataFrame:
    """level, face, a, b, c of the meshes of all levels, over the vertices of the finest. A vertex keeps its number in all levels."""
    return face_table(spark, splits).select("level", "face", "a", "b", "c")


def mesh_edges(spark: SparkSession, splits: int) -> DataFrame:
    """Distinct directed edges (sender, receiver) of all levels together."""
    return face_edges(merged_faces(spark, splits), F.col("a"), F.col("b"), F.col("c")).distinct()


def vertex_table(spark: SparkSession, splits: int) -> DataFrame:
    """vec_id, x, y, z of the finest vertices."""
    rows = [(i, *map(float, v)) for i, v in enumerate(hierarchy(splits)[0])]
    return spark.createDataFrame(rows, "vec_id long, x double, y double, z double")


def connected(points: DataFrame, splits: int, mode: str, share: float = 0.6) -> DataFrame:
    """Edges (vec_id, vertex) from points on the sphere to the mesh: `radius`, vertices within `share` of the longest edge;
    `triangle`, the three of the face that holds the point; `closest`, the closest vertex."""
    if mode == "radius":
        return within_radius(points, F.broadcast(vertex_table(points.sparkSession, splits)), share * longest_edge(splits)).select("vec_id", F.col("vertex_id").alias("vertex"))  # 10 * 4 ** splits + 2 vertices
    if mode == "triangle":
        return containing_faces(points, splits).select("vec_id", F.explode(F.array(*[F.col(c).cast("long") for c in "abc"])).alias("vertex"))
    if mode == "closest":
        return closest_vertices(points, splits).select("vec_id", F.col("vertex").cast("long").alias("vertex"))
    raise ValueError(f"mode is radius, triangle or closest, not {mode}")


def model_graphs(points: DataFrame, splits: int, share: float = 0.6, meshes: str = "all") -> dict[str, DataFrame]:
    """The three graphs of an encoder, a processor and a decoder: `grid2mesh` by radius, `mesh` (the edges of all levels, or
    of the finest alone), `mesh2grid` by triangle; edges as (sender, receiver)."""
    spark = points.sparkSession
    own = mesh_edges(spark, splits)
    if meshes == "finest":
        faces = merged_faces(spark, splits).where(F.col("level") == splits)
        own = face_edges(faces, F.col("a"), F.col("b"), F.col("c")).distinct()
    to_mesh, to_grid = connected(points, splits, "radius", share), connected(points, splits, "triangle")
    return {
        "grid2mesh": to_mesh.select(F.col("vec_id").alias("sender"), F.col("vertex").alias("receiver")),
        "mesh": own.select(F.col("sender").cast("long").alias("sender"), F.col("receiver").cast("long").alias("receiver")),
        "mesh2grid": to_grid.select(F.col("vertex").alias("sender"), F.col("vec_id").alias("receiver")),
    }


#: The sets of nodes that each graph of a model runs between.
ENDS = {"grid2mesh": ("grid", "mesh"), "mesh": ("mesh", "mesh"), "mesh2grid": ("mesh", "grid")}


def featured_graphs(points: DataFrame, splits: int, share: float = 0.6, meshes: str = "all", multiple: int = 1) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the three graphs of `model_graphs`, with the features that a model starts from.

    Nodes: set (`grid`, a point's vec_id, or `mesh`, a vertex), node, features (the cosine of the angle to the north pole, and
    cosine and sine of the longitude). Edges: graph, slot, sender, receiver, features (length and position of the sender in the
    receiver's frame, as shares of the graph's longest edge). Slots run from 0 by receiver, then sender, and are filled up to
    a multiple with edges from -1 to -1 without length. Positions of vertices are broadcast (10 * 4 ** splits + 2 rows)."""
    spark = points.sparkSession
    lat, lon = latlon(F.col("x"), F.col("y"), F.col("z"))
    placed = {"grid": points, "mesh": vertex_table(spark, splits)}
    nodes = {name: rows.select(F.col("vec_id").cast("long").alias("node"), lat.alias("lat"), lon.alias("lon")) for name, rows in placed.items()}
    features = F.array(F.sin(F.radians("lat")), F.cos(F.radians("lon")), F.sin(F.radians("lon")))
    all_nodes = [rows.select(F.lit(name).alias("set"), "node", features.alias("features")) for name, rows in nodes.items()]
    all_edges = []
    for graph, edges in model_graphs(points, splits, share, meshes).items():
        for end, of in zip(("sender", "receiver"), ENDS[graph], strict=True):
            at = nodes[of].select(F.col("node").alias(end), F.col("lat").alias(f"{end[0]}_lat"), F.col("lon").alias(f"{end[0]}_lon"))
            edges = edges.join(F.broadcast(at) if of == "mesh" else at, end)
        ordered = numbered(kept(edge_features(kept(edges))), ["receiver", "sender"], "slot")
        found = ordered.select("slot", "sender", "receiver", F.array("length", "dx", "dy", "dz").alias("features"))
        n = found.agg(F.count(F.lit(1)).alias("n"))
        fill = n.select(F.explode(F.when(F.col("n") % multiple > 0, F.sequence(F.col("n"), F.ceil(F.col("n") / multiple) * multiple - 1))).alias("slot"))
        minus, nothing = F.lit(-1).cast("long"), F.array(*[F.lit(0.0)] * 4)
        whole = found.unionByName(fill.select("slot", minus.alias("sender"), minus.alias("receiver"), nothing.alias("features")))
        all_edges.append(whole.select(F.lit(graph).alias("graph"), "slot", "sender", "receiver", "features"))
    return all_nodes[0].unionByName(all_nodes[1]), all_edges[0].unionByName(all_edges[1]).unionByName(all_edges[2])


def longest_edge(splits: int) -> float:
    vertices, levels = hierarchy(splits)
    f = levels[-1]
    return float(max(np.linalg.norm(vertices[f[:, i]] - vertices[f[:, j]], axis=1).max() for i, j in ((0, 1), (1, 2), (2, 0))))


def _side(p: list[Column], u: Column, v: Column) -> Column:
    """Above 0 if p lies to the left of the great circle from u to v."""
    x = lambda w, i: F.element_at(w, i)
    return sum((p[i] * (x(u, (i + 1) % 3 + 1) * x(v, (i + 2) % 3 + 1) - x(u, (i + 2) % 3 + 1) * x(v, (i + 1) % 3 + 1)) for i in range(3)), F.lit(0.0))


def _descend(points: DataFrame, splits: int) -> DataFrame:
    """points (vec_id, x, y, z on the unit sphere) with the face of each level's mesh that holds them; on a border the face
    in which the point lies deepest, then the smallest. Each level compares a point with the children of one face."""
    faces, p = face_table(points.sparkSession, splits), [F.col(c) for c in "xyz"]
    out = points.withColumn("face", F.lit(0).cast("long"))
    for level in range(splits + 1):
        kids = faces.where(F.col("level") == level).groupBy("parent").agg(F.sort_array(F.collect_list(F.struct("face", "a", "b", "c", "pa", "pb", "pc"))).alias("_kids"))
        depth = lambda k: F.least(_side(p, k["pa"], k["pb"]), _side(p, k["pb"], k["pc"]), _side(p, k["pc"], k["pa"]))
        ranked = F.transform("_kids", lambda k: F.struct(depth(k).alias("depth"), (-k["face"]).alias("order"), k["face"].alias("face"), k["a"].alias("a"), k["b"].alias("b"), k["c"].alias("c"), k["pa"].alias("pa"), k["pb"].alias("pb"), k["pc"].alias("pc")))
        joined = out.drop("best").join(F.broadcast(kids), out["face"] == kids["parent"]).drop("parent", "face")  # 20 * 4 ** splits faces
        out = joined.withColumn("best", F.array_max(ranked)).drop("_kids").withColumn("face", F.col("best.face"))
    return out


def containing_faces(points: DataFrame, splits: int) -> DataFrame:
    """vec_id, face and its vertices a, b, c in the mesh of `splits` splits."""
    return _descend(points, splits).select("vec_id", "face", "best.a", "best.b", "best.c")


def closest_vertices(points: DataFrame, splits: int) -> DataFrame:
    """vec_id, vertex, distance (chord). All faces are acute, so the closest vertex is one of the face that holds the point."""
    p = [F.col(c) for c in "xyz"]
    far = lambda v: F.sqrt(sum(((p[i] - F.element_at(v, i + 1)) ** 2 for i in range(3)), F.lit(0.0)))
    near = F.array_min(F.array(*[F.struct(far(F.col(f"best.p{k}")).alias("distance"), F.col(f"best.{k}").alias("vertex")) for k in "abc"]))
    return _descend(points, splits).select("vec_id", near.alias("n")).select("vec_id", "n.vertex", "n.distance")
