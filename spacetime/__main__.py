"""``python -m spacetime --output PREFIX --query NAME PATH... [--query ...]``."""

from spacetime.plans.cli import main

if __name__ == "__main__":
    for path in main():
        print(path)
