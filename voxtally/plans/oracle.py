"""The same queries as plain SQL, written from the definitions."""

from __future__ import annotations

from voxtally.plans import queries as q

CTES = {
    "shape_v": "select max(o_orderkey) // 640 + 1 as nz, (max(o_orderkey) // 640 + 2) // 2 as az from orders",
    "structures_v": """
        select cast(1 as bigint) as id, cast(null as bigint) as parent_structure_id, 'root' as acronym, 'Root' as name,
               '/1/' as structure_id_path
        union all select 10 + r_regionkey, 1, 'R' || r_regionkey, r_name, '/1/' || (10 + r_regionkey) || '/' from region
        union all select 100 + n_nationkey, 10 + n_regionkey, 'N' || n_nationkey, n_name,
               '/1/' || (10 + n_regionkey) || '/' || (100 + n_nationkey) || '/' from nation
        union all select 1000 + c_custkey, 100 + n_nationkey, 'C' || c_custkey, c_name,
               '/1/' || (10 + n_regionkey) || '/' || (100 + n_nationkey) || '/' || (1000 + c_custkey) || '/'
        from customer join nation on c_nationkey = n_nationkey""",
    "cells_v": """
        select l_orderkey * 8 + l_linenumber as cell_id, cast(l_orderkey // 640 as int) as z,
               cast(l_orderkey % 640 as int) as y,
               cast((l_partkey * 7 + l_suppkey * 13 + l_linenumber) % 96 as int) as x,
               cast(l_quantity as int) as volume_voxels,
               case l_returnflag when 'R' then 'TH' when 'A' then 'GFAP' else 'cFos' end as biomarker,
               l_quantity between 10 and 45 as passed
        from lineitem""",
    "mask_v": """
        select distinct z, y, x + d as x from cells_v, (values (-1), (0), (1)) t(d)
        where biomarker = 'TH' and x + d between 0 and 95""",
    "runs_v": """
        select cast(o_orderkey // 640 * az // nz as int) as z, cast(o_orderkey % 640 * 160 // 640 as int) as y,
               unnest(range(o_custkey % 24, least(o_custkey % 24 + 7, 23) + 1)) as x, o_custkey
        from orders, shape_v""",
    "labels_v": """
        select z, y, cast(x as int) as x, case when min(o_custkey) % 50 = 0 then 7 else min(o_custkey) + 1000 end as region_id,
               case when min(o_custkey) % 20 = 0 then 0 when x < 12 then 1 else 2 end as hemisphere_id
        from runs_v group by z, y, x""",
    "assigned_v": """
        select c.*, coalesce(l.region_id, 0) as region_id, coalesce(l.hemisphere_id, 0) as hemisphere_id
        from cells_v c cross join shape_v s
        left join labels_v l on l.z = least(c.z * s.az // s.nz, s.az - 1)
             and l.y = c.y * 160 // 640 and l.x = c.x * 24 // 96""",
    "ancestors_v": """
        select id, cast(unnest(string_split(trim(structure_id_path, '/'), '/')) as bigint) as ancestor from structures_v""",
    "tiers_v": """
        select len(string_split(trim(structure_id_path, '/'), '/')) as tier, id as structure_id, name as structure_name,
               acronym from structures_v""",
    "coloc_v": """
        select a.*, biomarker = 'cFos' and passed and m.z is not null as hit
        from assigned_v a left join mask_v m on a.z = m.z and a.y = m.y and a.x = m.x""",
    "geometry_v": """
        select tier, structure_id, structure_name, acronym, coalesce(t, 0) as total_voxels, coalesce(l, 0) as left_voxels,
               coalesce(r, 0) as right_voxels, coalesce(t, 0) * 1.6e-08 as total_volume_mm3,
               coalesce(l, 0) * 1.6e-08 as left_volume_mm3, coalesce(r, 0) * 1.6e-08 as right_volume_mm3
        from tiers_v left join (
            select ancestor, count(*) as t, count(*) filter (hemisphere_id = 1) as l, count(*) filter (hemisphere_id = 2) as r
            from labels_v join ancestors_v on region_id = id group by ancestor) on ancestor = structure_id""",
    "report_v": """
        select g.tier, g.structure_id, g.structure_name, g.acronym, coalesce(t, 0) as total_cells,
               coalesce(l, 0) as left_cells, coalesce(r, 0) as right_cells,
               total_volume_mm3, left_volume_mm3, right_volume_mm3,
               case when total_volume_mm3 <> 0 then coalesce(t, 0) / total_volume_mm3
                    when coalesce(t, 0) > 0 then cast('inf' as double) end as total_cells_per_mm3,
               case when left_volume_mm3 <> 0 then coalesce(l, 0) / left_volume_mm3
                    when coalesce(l, 0) > 0 then cast('inf' as double) end as left_cells_per_mm3,
               case when right_volume_mm3 <> 0 then coalesce(r, 0) / right_volume_mm3
                    when coalesce(r, 0) > 0 then cast('inf' as double) end as right_cells_per_mm3
        from geometry_v g left join (
            select ancestor, count(*) as t, count(*) filter (hemisphere_id = 1) as l, count(*) filter (hemisphere_id = 2) as r
            from assigned_v join ancestors_v on region_id = id
            where passed and biomarker = 'TH' group by ancestor) on ancestor = structure_id""",
    "asymmetry_v": """
        select *, abs(Diff_Percent) as Abs_Diff_Percent, coalesce(abs(Diff_Percent) >= 30, false) as Signif_Diff_gt30pct,
               case when left_cells_per_mm3 > right_cells_per_mm3 then 'Left'
                    when left_cells_per_mm3 < right_cells_per_mm3 then 'Right' else 'None' end as Dominant_Side
        from (select *, round_even(100 * case
                  when right_cells_per_mm3 is null or isinf(right_cells_per_mm3) then null
                  when right_cells_per_mm3 <> 0
                      then (left_cells_per_mm3 - right_cells_per_mm3) / right_cells_per_mm3 * 100
                  when left_cells_per_mm3 > 0 then 100.0 else 0.0 end, 0) / 100 as Diff_Percent
              from report_v)""",
    "voxels_v": """
        select distinct z, y, cast(x as int) as x from (
            select l_orderkey // 640 as z, l_orderkey % 640 as y,
                   unnest(range((l_partkey * 7 + l_suppkey * 13 + l_linenumber) % 96, least(
                       (l_partkey * 7 + l_suppkey * 13 + l_linenumber) % 96 + cast(l_quantity as int) % 3, 95) + 1)) as x
            from lineitem)""",
    "annotation_v": "select z, y, x, region_id as value from labels_v",
    "intensity_v": "select z, y, x, sum(volume_voxels) * 100 as value from cells_v group by z, y, x",
}

# Every view a CTE reads, in the order they must be defined.
ORDER = list(CTES)


def _with(body: str, recursive: bool = False, extra: str = "") -> str:
    text = body + extra
    needed: set[str] = set()
    while True:
        more = {n for n in ORDER if n not in needed and (n in text or any(n in CTES[m] for m in needed))}
        if not more:
            break
        needed |= more
    parts = [f"{n} as ({CTES[n]})" for n in ORDER if n in needed]
    if extra:
        parts.append(extra)
    head = "with recursive " if recursive else "with "
    return (head + ", ".join(parts) + " " if parts else "") + body


def _regex(words: list[str]) -> str:
    return "|".join(words)


_TAG = (
    f"(regexp_matches(NAME, '(?i){_regex(q.KEYWORDS)}') or regexp_matches(acronym, '^(?:{_regex(q.ACRONYMS)})'))"
)
_EXACT = "acronym in (" + ", ".join(f"'{a}'" for a in q.EXACT_ACRONYMS) + ")"

_NEIGHBOURS = {
    6: "abs(dz) + abs(dy) + abs(dx) = 1",
    18: "abs(dz) + abs(dy) + abs(dx) in (1, 2)",
    26: "abs(dz) + abs(dy) + abs(dx) > 0",
}


def _reach(connectivity: int) -> str:
    """Flood fill: every voxel carries the raster index of earlier voxels it can reach."""
    return f"""
        named_v as materialized (select z, y, x, (z * 640 + y) * 96 + x as r from voxels_v),
        steps_v as (select * from (values (-1), (0), (1)) a(dz), (values (-1), (0), (1)) b(dy), (values (-1), (0), (1)) c(dx)
                    where {_NEIGHBOURS[connectivity]}),
        links_v as materialized (select p.r as a, n.r as b from named_v p cross join steps_v
                    join named_v n on n.z = p.z + dz and n.y = p.y + dy and n.x = p.x + dx),
        reach_v(node, root) as (
            select r, r from named_v
            union select b, root from reach_v join links_v on node = a where root < b),
        roots_v as materialized (select node, min(root) as root from reach_v group by node)"""


def _chunked(connectivity: int, depth: int) -> str:
    """The chunk rule: flood fill inside chunks, then one contact upwards per component."""
    inside = _reach(connectivity).replace("n.x = p.x + dx)", f"n.x = p.x + dx where p.z % {depth} + dz between 0 and {depth - 1})")
    return f"""{inside},
        met_v as materialized (select u.root as a, l.root as b, n.r as voxel from named_v p
                  join named_v n on n.z = p.z + 1 and n.y = p.y and n.x = p.x
                  join roots_v u on u.node = p.r join roots_v l on l.node = n.r where n.z % {depth} = 0),
        chosen_v as materialized (select b, arg_min(a, voxel) as a from met_v group by b),
        both_v as materialized (select a, b from chosen_v union all select b, a from chosen_v),
        climb_v(node, root) as (select a, a from both_v union select b, root from climb_v join both_v on node = a where root < b),
        tops_v as materialized (select node, min(root) as top from climb_v group by node),
        final_v as (select r.node, coalesce(top, root) as root from roots_v r left join tops_v t on t.node = r.root)"""


_SUMS = """
    select root, count(*) as n, cast(sum(z) // count(*) as int) as z, cast(sum(y) // count(*) as int) as y,
           cast(sum(x) // count(*) as int) as x
    from named_v join roots_v on r = node group by root"""


def _nearest(view: str, source, target) -> str:
    """Target-driven order-0 resize; shapes are SQL expressions."""
    axes = [f"{a}_v as (select unnest(range({t})) as j_{a})" for a, t in zip("zyx", target)]
    pick = [f"v.{a} = ((2 * j_{a} + 1) * ({s})) // (2 * ({t}))" for a, s, t in zip("zyx", source, target)]
    return f"""with {', '.join(axes)}
        select cast(j_z as int) as z, cast(j_y as int) as y, cast(j_x as int) as x, value
        from {view} v join z_v on {pick[0]} join y_v on {pick[1]} join x_v on {pick[2]}"""


def _weights(name: str, n: str, t: str) -> str:
    """Both source neighbours of each target index, with integer weights out of 2t."""
    pos = f"abs((2 * j + 1) * ({n}) - ({t}))"
    return f"""
        {name}_p as (select j, case when p > (({n}) - 1) * 2 * ({t}) then 2 * (({n}) - 1) * 2 * ({t}) - p else p end as p
                     from (select j, {pos} as p from (select unnest(range({t})) as j))),
        {name} as (select j, p // (2 * ({t})) as i, 2 * ({t}) - p % (2 * ({t})) as w from {name}_p
                   union all select j, p // (2 * ({t})) + 1, p % (2 * ({t})) from {name}_p where p % (2 * ({t})) > 0)"""


def _linear(view: str, source, target) -> str:
    zs, ys, xs = [_weights(f"{a}_w", s, t) for a, s, t in zip("zyx", source, target)]
    (tz, ty, tx) = target
    return f"""with {zs}, {ys}, {xs},
        plane_v as (select v.z, y_w.j as y, x_w.j as x, sum(value * y_w.w * x_w.w) // (4 * ({ty}) * ({tx})) as value
                    from {view} v join y_w on v.y = y_w.i join x_w on v.x = x_w.i group by all)
        select cast(z_w.j as int) as z, cast(p.y as int) as y, cast(p.x as int) as x,
               cast(sum(value * z_w.w) // (2 * ({tz})) as bigint) as value
        from plane_v p join z_w on p.z = z_w.i group by all having sum(value * z_w.w) // (2 * ({tz})) <> 0"""


_AZ, _NZ = "(select az from shape_v)", "(select nz from shape_v)"
_ATLAS, _NATIVE = (_AZ, "160", "24"), (_NZ, "640", "96")
_UP, _DOWN = (f"{_AZ} * 2 + 1", "200", "48"), (f"greatest({_AZ} // 2, 1)", "53", "17")
_SMALL = (f"greatest({_NZ} // 2, 1)", "160", "16")


def _halves() -> list[tuple[str, str, str]]:
    levels = [_ATLAS]
    for _ in range(4):
        levels.append(tuple(f"greatest(({s}) // 2, 1)" for s in levels[-1]))
    return levels


def _pyramid() -> str:
    levels = _halves()
    parts = ["l0_v as (select z, y, x, value from annotation_v)"]
    for k in range(1, 5):
        parts.append(f"l{k}_v as ({_nearest(f'l{k - 1}_v', levels[k - 1], levels[k])})")
    picks = " union all ".join(f"select z, y, x, value, {k} as level from l{k}_v" for k in range(5))
    return f"with {', '.join(parts)} {picks}"


def _subtree(acronym: str) -> str:
    return f"""select distinct id from structures_v
               where contains(structure_id_path, (select structure_id_path from structures_v where acronym = '{acronym}'))"""


def _region(acronym: str, target: int) -> str:
    return f"select z, y, x, cast({target} as bigint) as value from annotation_v where value in ({_subtree(acronym)})"


_BODIES = {
    "volume_filter_o21": """select cell_id, z, y, x, volume_voxels, biomarker,
        biomarker = 'cFos' and passed as passed_filter from cells_v""",
    "filter_summary_o54": """select count(*) as total, count(*) filter (passed) as passed from cells_v where biomarker = 'cFos'""",
    "foreground_o22": "select z, count(*) as foreground from annotation_v where value % 5 <> 0 group by z",
    "outside_drop_o23": f"""select count(*) filter (z >= 1 and x + 2 < 96) as kept,
        count(*) filter (not (z >= 1 and x + 2 < 96)) as dropped from cells_v""",
    "null_region_drop_o25": "select biomarker, count(*) as cells from assigned_v where biomarker = 'TH' group by biomarker",
    "system_tag_exact_o26": f"select id, acronym, {_EXACT} as is_target from structures_v",
    "system_tag_regex_o26": f"select id, acronym, {_TAG.replace('NAME', 'name')} as is_target from structures_v",
    "cell_volume_um3_o27": "select biomarker, sum(volume_voxels * 16.0::double) as volume_um3 from cells_v group by biomarker",
    "native_to_atlas_o63": """select cell_id, z * az // nz as az, y * 160 // 640 as ay, x * 24 // 96 as ax
        from cells_v, shape_v""",
    "clamp_o64": """select cell_id,
        cast(greatest(0, least(s.az - 1, floor((z * 2 - 5) * s.az / nz))) as bigint) as az,
        cast(greatest(0, least(159, floor((y * 2 - 9) * 160 / 640))) as bigint) as ay,
        cast(greatest(0, least(23, floor((x * 2 - 7) * 24 / 96))) as bigint) as ax from cells_v, shape_v s""",
    "permute_axes_o8": "select x as z, z as y, y as x, value from annotation_v",
    "path_parse_o70": """select id, len(string_split(trim(structure_id_path, '/'), '/')) as tier, id as leaf,
        cast(1 as bigint) as root from structures_v""",
    "structure_tallies_o31": """select s.id, acronym, count(a.id) as total_cells,
        count(a.id) filter (hemisphere_id = 1) as left_cells, count(a.id) filter (hemisphere_id = 2) as right_cells
        from structures_v s left join (select region_id as id, hemisphere_id from assigned_v
             where passed and biomarker = 'GFAP') a on a.id = s.id group by s.id, acronym""",
    "region_lookup_o35": """select cell_id, z, y, x, cast(region_id as int) as found_region,
        cast(hemisphere_id as tinyint) as found_hemisphere from assigned_v""",
    "assign_regions_o36": """select cell_id, x, biomarker,
        cast(case when biomarker = 'TH' then region_id end as int) as region_id,
        cast(case when biomarker = 'TH' then hemisphere_id else 0 end as tinyint) as hemisphere_id from assigned_v""",
    "assigned_count_o36": "select count(*) as assigned from cells_v where biomarker = 'TH'",
    "points_in_mask_o37": """select cell_id, c.z, c.y, c.x - 2 as x, m.z is not null as in_mask
        from cells_v c left join mask_v m on m.z = c.z and m.y = c.y and m.x = c.x - 2""",
    "colocalize_pair_o38": """select cell_id, x, volume_voxels, biomarker, hit as "colocalized_with_TH" from coloc_v""",
    "colocalize_pairs_o39": """select biomarker, th as "colocalized_with_TH", gfap as "colocalized_with_GFAP", count(*) as cells from (
        select c.biomarker, c.biomarker in ('cFos', 'GFAP') and passed and m.z is not null as th,
               c.biomarker = 'cFos' and passed and g.z is not null as gfap
        from cells_v c left join mask_v m on m.z = c.z and m.y = c.y and m.x = c.x
        left join (select distinct z, y, x + d as x from cells_v, (values (-1), (0), (1)) t(d)
                   where biomarker = 'GFAP' and x + d between 0 and 95) g on g.z = c.z and g.y = c.y and g.x = c.x) group by all""",
    "float_mask_points_o37": """select cell_id, c.z, c.y, c.x - 2 as x, m.z is not null as in_mask
        from cells_v c left join mask_v m on m.z = c.z and m.y = c.y and m.x = c.x - 2 and m.x % 3 <> 0""",
    "subtree_ids_o41": _subtree("R1"),
    "whole_brain_report_o44": "select biomarker, count(*) as total_cells from cells_v where passed group by biomarker",
    "region_tallies_o45": """select cast(region_id as bigint) as id, count(*) as total_cells,
        count(*) filter (hemisphere_id = 1) as left_cells, count(*) filter (hemisphere_id = 2) as right_cells
        from assigned_v where passed and biomarker = 'cFos' group by region_id""",
    "region_voxels_hemi_o48": """select region_id as id, count(*) as total_voxels,
        count(*) filter (hemisphere_id = 1) as left_voxels, count(*) filter (hemisphere_id = 2) as right_voxels
        from labels_v group by region_id""",
    "region_voxels_midline_o48": """select region_id as id, count(*) as total_voxels,
        count(*) filter (x < 12) as left_voxels, count(*) filter (x >= 12) as right_voxels from labels_v group by region_id""",
    "geometry_report_o49": "select * from geometry_v",
    "coloc_tallies_o50": """select cast(region_id as bigint) as id, count(*) as tested_cells,
        count(*) filter (hit) as colocalized_cells from coloc_v where passed and biomarker = 'cFos' group by region_id""",
    "coloc_summary_o51": """select count(*) as tested, count(*) filter (hit) as colocalized from coloc_v
        where passed and biomarker = 'cFos'""",
    "coloc_report_o52": """select tier, structure_id, structure_name, acronym, coalesce(n, 0) as tested_cells,
        coalesce(h, 0) as colocalized_cells, h / nullif(n, 0) as colocalization_rate
        from tiers_v left join (select ancestor, count(*) as n, count(*) filter (hit) as h
             from coloc_v join ancestors_v on region_id = id where passed and biomarker = 'cFos' group by ancestor)
        on ancestor = structure_id""",
    "tiered_report_o53": "select * from asymmetry_v",
    "target_summary_o59": f"""select tier as "Source_Tier", * exclude (tier), true as "Is_Target_System" from asymmetry_v
        where total_cells >= {q.THRESHOLD} and {_TAG.replace('NAME', 'structure_name')}""",
    "density_o29": """select c.id, case when v * 1.6e-08 <> 0 then n / (v * 1.6e-08)
             when v is not null then cast('inf' as double) end as cells_per_left_mm3
        from (select cast(region_id as bigint) as id, count(*) as n from assigned_v
              where passed and biomarker = 'TH' group by region_id) c
        left join (select region_id as id, count(*) filter (hemisphere_id = 1) as v from labels_v group by region_id) g
        on g.id = c.id""",
    "subvolume_o7": """select z - 1 as z, y - 10 as y, x - 3 as x, value from annotation_v, shape_v
        where z >= 1 and z < az and y >= 10 and y < 150 and x >= 3 and x < 20""",
    "relabel_subtree_o73": _region("R2", 12),
    "region_has_voxels_o55": f"""select 'R3' as asked, count(*) > 0 as has_voxels from ({_region('R3', 13)})
        union all select 'unused', false""",
    "resample_nearest_up_o74": _nearest("annotation_v", _ATLAS, _UP),
    "resample_nearest_down_o74": _nearest("annotation_v", _ATLAS, _DOWN),
    "resample_linear_up_o74": _linear("annotation_v", _ATLAS, _UP),
    "resample_linear_down_o74": _linear("annotation_v", _ATLAS, _DOWN),
    "atlas_to_native_o76": f"""select z, value, count(*) as voxels, cast(sum(y) as bigint) as sum_y,
        cast(sum(x) as bigint) as sum_x from ({_nearest('annotation_v', _ATLAS, _NATIVE)}) group by z, value""",
    "scatter_o77": "select distinct z, y, x - 3 as x, cast(255 as bigint) as value from cells_v where x >= 3",
    "redraw_native_o78": """select distinct z, y, x, cast(255 as bigint) as value from cells_v
        where passed and biomarker = 'TH'""",
    "redraw_atlas_o79": """select distinct cast((z + 2) * az // nz as int) as z, cast(y * 160 // 640 as int) as y,
        cast(x * 24 // 96 as int) as x, cast(255 as bigint) as value from cells_v, shape_v
        where passed and biomarker = 'cFos' and (z + 2) * az // nz < az""",
    "extract_region_o80": _nearest(f"({_region('R4', 14)})", _ATLAS, _NATIVE),
    "registration_input_o82": f"select y as z, z as y, x, value from ({_linear('intensity_v', _NATIVE, _SMALL)})",
    "pyramid_levels_o83": _pyramid(),
    "zarr_scan_o4": "select z, y, x, value from annotation_v",
    "tiff_scan_o2": "select z, y, x, value from annotation_v",
    "nifti_scan_o3": "select z, y, x, value from annotation_v",
    "slice_folder_o6": "select z, y, x, value from annotation_v",
    "nifti_folder_o10e": "select z, y, x, value from annotation_v",
    "permuted_read_o8": "select z, y, x, value from annotation_v",
    "convert_o12": "select z, y, x, value from annotation_v",
    "image_folder_o5": "select z, y, x, cast(hemisphere_id as bigint) as value from labels_v where hemisphere_id <> 0",
    "image_folder_deep_o5": "select z, y, x, cast(hemisphere_id * 30000 as bigint) as value from labels_v where hemisphere_id <> 0",
    "zarr_blosc_scan_o4": "select z, y, x, value from annotation_v",
    "extract_many_o81": f"""select 'R1' as acronym, value, z, count(*) as voxels
        from ({_nearest(f"({_region('R1', 11)})", _ATLAS, _NATIVE)}) group by all
        union all select 'R2', value, z, count(*) from ({_nearest(f"({_region('R2', 12)})", _ATLAS, _NATIVE)}) group by all""",
    "backups_o93": """select cast(age as int) as age, count(*) filter (volume_voxels > 10 * (age + 1)) as cells
        from cells_v, range(4) t(age) group by age""",
    "slab_writes_o10": "select z, y, x, value from annotation_v",
    "ome_zarr_level_o10b": f"""select z, y, x, value, 0 as level from annotation_v
        union all select *, 1 as level from ({_nearest("annotation_v", _ATLAS, _halves()[1])})""",
    "structures_dirty_ids_o16": """select acronym, case when id % 7 in (0, 1, 2) then 0 else id end as id, parent_structure_id
        from structures_v""",
    "box_read_o7": """select z, y, x, value from annotation_v, shape_v
        where z >= 1 and z < az and y >= 10 and y < 120 and x >= 5 and x < 20""",
    "cells_scan_o14": """select cell_id, z, y, x, volume_voxels, cast(0 as tinyint) as hemisphere_id from cells_v
        where biomarker = 'GFAP' and passed""",
    "structures_csv_o16": "select * from structures_v",
    "whole_brain_csv_o17": "select biomarker, count(*) as total_cells from cells_v where passed group by biomarker",
    "distinct_regions_o60": "select distinct cast(region_id as int) as region_id from assigned_v",
}

_ROLLUP = """
    select tier, structure_id, structure_name, acronym, cast(coalesce(t, 0) as bigint) as total_cells,
           cast(coalesce(l, 0) as bigint) as left_cells, cast(coalesce(r, 0) as bigint) as right_cells
    from tiers_v left join (select node, count(*) as t, count(*) filter (hemisphere_id = 1) as l,
             count(*) filter (hemisphere_id = 2) as r from assigned_v join climb_v on region_id = leaf
         where passed and biomarker = 'cFos' group by node) on node = structure_id"""
_CLIMB = """climb_v(leaf, node) as (select id, id from structures_v
    union all select leaf, parent_structure_id from climb_v join structures_v on node = id
    where parent_structure_id is not null)"""


def _wrap(body: str) -> str:
    """Bodies with their own WITH list go into a subquery."""
    return f"select * from ({body})" if body.lstrip().startswith("with ") else body


ORACLE = {name: _with(_wrap(body)) for name, body in _BODIES.items()}
ORACLE["tier_rollup_o46"] = _with(_ROLLUP, recursive=True, extra=_CLIMB)
for _n in (6, 18, 26):
    ORACLE[f"components_{_n}_o47"] = _with(_SUMS, recursive=True, extra=_reach(_n))
ORACLE["components_chunked_o47"] = _with(_SUMS.replace("roots_v", "final_v"), recursive=True, extra=_chunked(18, 5))
ORACLE["components_of_blocks_o47"] = ORACLE["components_18_o47"]
ORACLE["components_small_bricks_o47"] = ORACLE["components_18_o47"]
_LO, _HI = (2, 60)
ORACLE["registered_brain_o88"] = _with(
    f"""select row_number() over (order by root) as cell_id, f.z, f.y, f.x, cast(n as int) as volume_voxels,
        cast(coalesce(region_id, 0) as int) as region_id, cast(coalesce(hemisphere_id, 0) as tinyint) as hemisphere_id,
        n between {_LO} and {_HI} as passed_filter
        from ({_SUMS}) f cross join shape_v s left join labels_v l on l.z = least(f.z * s.az // s.nz, s.az - 1)
             and l.y = f.y * 160 // 640 and l.x = f.x * 24 // 96""",
    recursive=True,
    extra=_reach(18),
)
ORACLE["unregistered_brain_o89"] = _with(
    f"select distinct z, y, x, cast(255 as bigint) as value from ({_SUMS}) where n between {_LO} and {_HI}",
    recursive=True,
    extra=_reach(18),
)
ORACLE["detect_cells_o47"] = _with(
    f"""select row_number() over (order by root) as cell_id, z, y, x, cast(n as int) as volume_voxels,
        cast(n * 16.0 as float) as volume_um3, 'cFos' as biomarker, cast(0 as tinyint) as hemisphere_id, 'B1' as brain_id,
        'r1' as run_id, false as passed_filter from ({_SUMS})""",
    recursive=True,
    extra=_reach(18),
)
ORACLE["run_journal_o90"] = _with(
    f"""select unnest(['detect', 'filter', 'report', 'redraw']) as step, 'done' as outcome,
        unnest([count(*), count(*) filter (n between {_LO} and {_HI}), count(*) filter (n between {_LO} and {_HI}), null]) as cells
        from ({_SUMS})""",
    recursive=True,
    extra=_reach(18),
)
ORACLE["registered_outputs_o88"] = _with(
    f"""select distinct z, y, x, cast(255 as bigint) as value, 'native' as output from ({_SUMS}) where n between {_LO} and {_HI}
        union all select distinct cast(f.z * s.az // s.nz as int), cast(f.y * 160 // 640 as int), cast(f.x * 24 // 96 as int), 255, 'atlas'
        from ({_SUMS}) f, shape_v s where n between {_LO} and {_HI}
        union all select z, y, x, value, 'roi' from ({_nearest(f"({_region('R1', 11)})", _ATLAS, _NATIVE)})""",
    recursive=True,
    extra=_reach(18),
)
# The same answers from stored volumes, read box by box.
ORACLE["region_lookup_stored_o35"] = ORACLE["region_lookup_o35"]
ORACLE["region_voxels_stored_o48"] = ORACLE["region_voxels_hemi_o48"]
ORACLE["geometry_stored_o49"] = ORACLE["geometry_report_o49"]
