"""Looking into folders from inside a task: names first, sizes and times only of what is wanted.

Links: a link to a file is listed with that file's size and time; a link to a folder, and one
that leads nowhere, is passed over, so that no tree is endless. What vanishes while a folder is
listed is passed over too.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

PAGE = 10_000  # entries that are passed on at once, and names that one task looks at alone
SHARES = 64    # tasks that a larger folder is dealt to

# (name, size, modification time in ms, is a folder)
Entry = tuple[str, int, int, bool]


def file_locator():
    """A function path -> (pyarrow file system, path inside it).

    It is made here and not imported there, so that tasks need nothing but pyarrow. Only the
    scheme and authority are parsed as a URI; names may hold any characters.
    """

    def located(path: str):
        from pyarrow import fs

        scheme, found, rest = path.partition("://")
        if not found:
            return fs.LocalFileSystem(), path.removeprefix("file:")
        authority, _, inner = rest.partition("/")
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + inner
        system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
        return system, f"{base.rstrip('/')}/{inner}"

    return located


located = file_locator()


def is_local(folder: str) -> bool:
    from pyarrow import fs

    return isinstance(located(folder)[0], fs.LocalFileSystem)


def in_share(name: str, share: int, shares: int) -> bool:
    return shares == 1 or zlib.crc32(name.encode("utf-8", "surrogateescape")) % shares == share


def _local_entry(entry: os.DirEntry) -> Entry | None:
    try:
        if entry.is_dir(follow_symlinks=False):
            return entry.name, 0, entry.stat().st_mtime_ns // 1_000_000, True
        if entry.is_symlink() and entry.is_dir():
            return None
        info = entry.stat()
    except FileNotFoundError:
        return None
    return entry.name, info.st_size, info.st_mtime_ns // 1_000_000, False


def entries(
    folder: str, share: int = 0, shares: int = 1, wanted: Callable[[str], bool] = lambda name: True, folders: bool = True
) -> Iterator[Entry]:
    """What a folder holds, every name counts. Of several shares only the files of one are looked at (and all
    folders), and of files only those whose name is wanted; `folders` off leaves folders out."""
    from pyarrow import fs

    system, base = located(folder)
    if isinstance(system, fs.LocalFileSystem):  # this one can be read as a stream
        with os.scandir(base or "/") as found:
            for entry in found:
                folder_like = entry.is_dir(follow_symlinks=False)
                if folders if folder_like else in_share(entry.name, share, shares) and wanted(entry.name):
                    seen = _local_entry(entry)
                    if seen is not None:
                        yield seen
    else:
        for info in system.get_file_info(fs.FileSelector(base)):
            folder_like = info.type == fs.FileType.Directory
            if folders if folder_like else in_share(info.base_name, share, shares) and wanted(info.base_name):
                yield info.base_name, info.size or 0, (info.mtime_ns or 0) // 1_000_000, folder_like


def one_entry(path: str) -> Entry | None:
    """The entry of one file, without listing its folder; None where there is no file."""
    from pyarrow import fs

    system, inner = located(path)
    info = system.get_file_info(inner)
    if info.type != fs.FileType.File:
        return None
    return info.base_name, info.size or 0, (info.mtime_ns or 0) // 1_000_000, False


def names_in(folder: str) -> Iterator[str]:
    """The names a folder holds, nothing else being looked at."""
    if is_local(folder):
        with os.scandir(located(folder)[1] or "/") as found:
            for entry in found:
                yield entry.name
    else:
        yield from (name for name, *_ in entries(folder))


def shares_of(folder: str) -> int:
    """Into how many shares the listing of a folder is worth dealing. Stores that tell names, sizes and times in
    one answer have nothing to deal."""
    if not is_local(folder):
        return 1
    for n, _ in enumerate(names_in(folder)):
        if n >= PAGE:
            return SHARES
    return 1


def walk(folder: str, recursive: bool, share: int = 0, shares: int = 1, wanted: Callable[[str], bool] = lambda name: True) -> Iterator[tuple[str, Entry]]:
    """(folder, entry) of the files of a folder, or of the tree below it, one folder after the other."""
    waiting = [folder]
    while waiting:
        at = waiting.pop()
        for entry in entries(at, share, shares, wanted, folders=recursive):
            if entry[3]:
                waiting.append(f"{at}/{entry[0]}")
            else:
                yield at, entry


def there(system, path: str) -> bool:
    from pyarrow import fs

    return system.get_file_info(path).type != fs.FileType.NotFound


def move_new(system, source: str, target: str) -> bool:
    """Move a file to a path that nothing has; false, and nothing moved, where something has it.
    On local disks two movers cannot get the same path, and a move cut short is finished by the next."""
    from pyarrow import fs

    if not isinstance(system, fs.LocalFileSystem):
        if there(system, target):
            return False
        system.move(source, target)
        return True
    try:
        os.link(source, target)
    except FileExistsError:
        if not os.path.samefile(source, target):
            return False
    os.unlink(source)
    return True
