"""Import every registration module (order = listing order)."""

from . import clean_room  # noqa: F401
from . import planning  # noqa: F401
from . import vendor  # noqa: F401
from . import flat_files  # noqa: F401
from . import reports  # noqa: F401
from . import io  # noqa: F401
from . import landed  # noqa: F401
from . import stock  # noqa: F401
from . import documents  # noqa: F401
