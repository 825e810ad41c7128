"""Which version of a folder counts.

Below `<root>/_current` there is one small file per key, whose name says which version is the
current one: `<key>.<number>.<version>`. The largest number counts. A version is written in
full before its file appears, by a rename to a name that nothing else has; the files of
earlier versions go afterwards. Whenever a writer dies, readers find the old version or the
new one. Each key has one writer at a time.

Names are all there is to read, so one listing gives the state of a table. Keys that switch
together, of which there may be thousands, share a file: `_list.<number>.<id>` has a line with
key and version for each. It goes through Hadoop's file systems, like Spark's own files.
"""

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from py4j.protocol import Py4JJavaError

FOLDER = "_current"
LIST = "_list"
THREADS = 16  # calls to the file system wait more than they work


def new_version():
    return uuid.uuid4().hex[:12]


def each(act, items):
    """The results of an action on each item, several items at a time."""
    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(act, items))


@lru_cache(1)
def _path(jvm):
    return jvm.org.apache.hadoop.fs.Path  # each part of the name is a call


def _at(spark, path):
    place = _path(spark._jvm)(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark, folder):
    """The names in a folder; none if there is no such folder."""
    fs, place = _at(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def stamped(spark, pattern, parts):
    """The last `parts` parts of the paths that match, as a tuple, and when each last changed."""
    fs, place = _at(spark, pattern)
    found = []
    for status in fs.globStatus(place) or []:
        own = status.getPath().toString().split("/")[-parts:]  # each call takes its time
        found.append((tuple(own), status.getModificationTime()))
    return sorted(found)


def matching(spark, pattern, parts):
    """The last `parts` parts of the paths that match."""
    return [own for own, _ in stamped(spark, pattern, parts)]


def remove(spark, path):
    fs, place = _at(spark, path)
    fs.delete(place, True)


def write_text(spark, path, text):
    """A new file."""
    fs, place = _at(spark, path)
    stream = fs.create(place, False)
    if text:
        stream.write(text.encode())
    stream.close()


def read_text(spark, path):
    """The text of a file; None if there is no such file."""
    fs, place = _at(spark, path)
    try:
        stream = fs.open(place)
    except Py4JJavaError:
        if fs.exists(place):
            raise
        return None
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def hidden(spark, folder, text=""):
    """The path of a file in the folder, under a name that readers pass over."""
    path = f"{folder}/.{uuid.uuid4().hex}"
    write_text(spark, path, text)
    return path


def appear(spark, aside, path):
    """The file gets a name that is new."""
    (fs, aside), (_, place) = _at(spark, aside), _at(spark, path)
    if not fs.rename(aside, place):
        raise OSError(f"{path} could not be made")


def _files(spark, root):
    """(key, number, version, name of the file) of each pointer."""
    while True:
        found = []
        for name in names(spark, f"{root}/{FOLDER}"):
            if name.count(".") != 2 or name.startswith("."):
                continue
            key, number, version = name.split(".")
            named = [(key, version)]
            if key == LIST:
                text = read_text(spark, f"{root}/{FOLDER}/{name}")
                if text is None:
                    break  # a writer has replaced all in it meanwhile
                named = [line.split("\t") for line in text.splitlines()]
            found += [(k, int(number), v, name) for k, v in named]
        else:
            return found


def _latest(files):
    """The largest (number, version) of each key."""
    latest = {}
    for key, number, version, _ in files:
        latest[key] = max((number, version), latest.get(key, (number, version)))
    return latest


def current(spark, root):
    """The current version of each key."""
    return {key: version for key, (_, version) in sorted(_latest(_files(spark, root)).items())}


def switch(spark, root, versions):
    """Make these the current versions of their keys, one key after the other. All files are
    made before the first one appears."""
    before = {key: number for key, (number, _) in _latest(_files(spark, root)).items()}
    fs, place = _at(spark, f"{root}/{FOLDER}")
    fs.mkdirs(place)
    asides = each(lambda _: hidden(spark, f"{root}/{FOLDER}"), versions)
    for aside, (key, version) in zip(asides, versions.items()):
        appear(spark, aside, f"{root}/{FOLDER}/{key}.{before.get(key, 0) + 1}.{version}")


def switch_together(spark, root, versions):
    """Make these the current versions of their keys, all at once: one file lists them."""
    before = [number for key, (number, _) in _latest(_files(spark, root)).items() if key in versions]
    fs, place = _at(spark, f"{root}/{FOLDER}")
    fs.mkdirs(place)
    aside = hidden(spark, f"{root}/{FOLDER}", "".join(f"{key}\t{version}\n" for key, version in versions.items()))
    appear(spark, aside, f"{root}/{FOLDER}/{LIST}.{max(before, default=0) + 1}.{new_version()}")


def forget(spark, root, keys):
    """Remove the pointers of these keys but the current ones, and the lists in which nothing is
    current; gives the (key, version) whose pointers are gone and which nothing names any more."""
    files = _files(spark, root)
    latest = _latest(files)
    used = {name for key, number, version, name in files if (number, version) == latest[key]}
    gone = [
        (key, version, name) for key, number, version, name in files
        if (name not in used if name.startswith(f"{LIST}.") else key in keys and version != latest[key][1])
    ]
    each(lambda name: remove(spark, f"{root}/{FOLDER}/{name}"), dict.fromkeys(name for *_, name in gone))
    return [(key, version) for key, version, _ in gone]
