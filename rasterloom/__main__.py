"""Command line: python -m rasterloom stats|split|patches …"""

from __future__ import annotations

import argparse

from rasterloom.plans import pipeline, scenes
from rasterloom.session import builder
from rasterloom.sources import products, rasters, sinks


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rasterloom")
    commands = parser.add_subparsers(dest="command", required=True)
    stats = commands.add_parser("stats", help="figures by channel and spacing, products by month")
    stats.add_argument("--data_root", required=True)
    stats.add_argument("--out_json", required=True)
    stats.add_argument("--spacings", type=float, nargs="+", default=[50, 100, 200])
    split = commands.add_parser("split", help="balanced training and validation lists")
    patches = commands.add_parser("patches", help="training patches with segments")
    for command in (split, patches):
        command.add_argument("--data_root", required=True)
        command.add_argument("--labels_root", required=True)
        command.add_argument("--annotated_products_txt", required=True)
        command.add_argument("--output", required=True)
    split.add_argument("--percentage", type=int, default=80, choices=range(1, 100), metavar="1..99")
    patches.add_argument("--shp_path")
    patches.add_argument("--pixel_spacing", type=float, default=200)
    patches.add_argument("--patch_size", type=int, default=384)
    patches.add_argument("--overlap", type=float, default=0)
    patches.add_argument("--irgs_classes", type=int, default=70)
    patches.add_argument("--irgs_iterations", type=int, default=200)
    for command in (stats, patches):
        command.add_argument("--nodata", type=float, help="raster value of missing pixels")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = builder("rasterloom").getOrCreate()
    if args.command == "stats":
        pixels, found = scenes.load(spark, args.data_root, nodata=args.nodata)
        figures, months = scenes.statistics(pixels, found, args.spacings)
        sinks.write_stats_json(figures, months, args.out_json)
        sinks.write_failures(found.withColumnRenamed("product", "name"), args.out_json.removesuffix(".json") + "_failures.json")
        return
    names = products.product_list(spark, args.annotated_products_txt)
    if args.command == "split":
        marks = products.read_annotations(spark, args.labels_root).join(names.withColumnRenamed("name", "scene"), "scene", "left_semi")
        shares, parts, report = pipeline.class_split(marks, names.withColumnRenamed("name", "scene"), args.percentage)
        sinks.write_split(parts, args.output, args.percentage)
        shares.write.mode("overwrite").json(f"{args.output}/classes")
        sinks.write_split_summary(report, f"{args.output}/summary")
        return
    pixels, found = scenes.load(spark, args.data_root, names, args.nodata)
    marks = products.read_annotations(spark, args.labels_root, classes=2)
    grid = scenes.labelled(scenes.resample(pixels, found, args.pixel_spacing), marks)
    ocean = rasters.read_polygons(spark, args.shp_path) if args.shp_path else None
    rows = scenes.patches(scenes.land_mask(grid, found, ocean), found, args.pixel_spacing, args.patch_size, args.overlap)
    sinks.write_patches(scenes.segment(rows, args.irgs_classes, args.irgs_iterations), args.output)
    status = products.scene_status(found.withColumnRenamed("product", "name"), marks)
    sinks.write_failures(status, f"{args.output.rstrip('/')}_failures.json")


if __name__ == "__main__":
    main()
