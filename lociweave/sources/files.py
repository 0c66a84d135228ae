"""Byte access to files and folders of parts, on any file system that ``pyarrow.fs`` knows."""

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if path.startswith("/"):
        path = "file://" + path
    elif path.startswith("file:/") and not path.startswith("file://"):
        path = path.replace("file:/", "file:///", 1)
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def parts_of(path: str) -> list[tuple[str, int]]:
    """``(path, size)`` of a file, or of the parts of a folder by name; hidden files are no parts."""
    system, name = located(path)
    info = system.get_file_info(name)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type != fs.FileType.Directory:
        return [(path, info.size)]
    inside = system.get_file_info(fs.FileSelector(name))
    kept = [f for f in inside if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))]
    return [(f"{path.rstrip('/')}/{f.base_name}", f.size) for f in sorted(kept, key=lambda f: f.base_name)]


def exists(path: str) -> bool:
    system, name = located(path)
    return system.get_file_info(name).type != fs.FileType.NotFound
